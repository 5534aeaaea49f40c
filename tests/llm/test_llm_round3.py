"""The Merkle manifest, hard negatives and wrapper induction against plain Python, with odd rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import merkle, negatives, simhash, wrappers


# 11
def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    """Levels of a tree as hex digests."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([_hash(*low[a : a + 8]) for a in range(0, len(low), 8)])
    return levels


def _brute_manifest(rows):
    """rows of (order, group, fields, tampered fields): (order, leaf, subroot, root, proof, folded) of each, by definition."""
    digest = lambda fields: _hash(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])
    groups = sorted({g for _, g, _, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted(((o is not None, o or 0, digest(f), digest(t)) for o, h, f, t in rows if h == g)) for g in groups}
    trees = {g: _tree([m[2] for m in members[g]]) for g in groups}
    top = _tree([trees[g][-1][0] for g in groups])
    out = []
    for at, g in enumerate(groups):
        for k, (some, o, leaf, tampered) in enumerate(members[g]):
            proof, value = "", tampered
            for levels, i in ((trees[g], k), (top, at)):
                for level in levels[:-1]:
                    run = level[i // 8 * 8 : i // 8 * 8 + 8]
                    proof += "".join(d for j, d in enumerate(run) if j != i % 8)
                    value = _hash(*run[: i % 8], value, *run[i % 8 + 1 :])
                    i //= 8
            out.append((o if some else None, leaf, trees[g][-1][0], top[-1][0], _hash(proof), value))
    return sorted(out, key=repr)


def test_postorder_places_by_construction():
    """Every node of every small tree stands where appending in completion order puts it."""
    for n in [1, 2, 7, 8, 9, 63, 64, 65, 72, 513, 600]:
        counts, want, place = [n], {}, 0
        while counts[-1] > 1:
            counts.append(-(-counts[-1] // 8))
        for i in range(n):
            want[0, i], place = place, place + 1
            for level in range(1, len(counts)):
                if (i + 1) % 8**level and i + 1 < n:
                    break
                want[level, i // 8**level], place = place, place + 1
        assert merkle.height(n) == len(counts) - 1
        assert {(level, k): int(merkle.node_place(level, k, n)) for level, c in enumerate(counts) for k in range(c)} == want


@pytest.mark.parametrize("tier", [4, 1, 2])
def test_manifest_equals_brute_force(spark, tier):
    rng = random.Random(11)
    langs = [None, "", "de", "é", "z", *[f"l{k}" for k in range(9)]]
    rows = [(k, "Ab" * rng.randrange(5) if k % 9 else None, rng.choice([None, "de", "de", "de", "de", "é"]), rng.choice(["X é", "", None, "long TEXT " * 9])) for k in range(700)]
    rows += [(2000 + k, "s", lang, "T") for k, lang in enumerate(langs)]  # lone leaves
    rows += [(5, "s", "de", "same")] * 40 + [(None, None, "de", None), (None, "x", None, "Y"), (9999, "s", "de", "W" * 200_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, text string, leaf string, k int").repartition(5)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "text")]
    lowered = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    got = merkle.manifest(df, F.col("lang"), F.col("doc_id"), fields, [*fields[:-1], lowered], tier).collect()
    got = sorted(((r.order, *[bytes(r[c]).hex() for c in ("leaf", "subroot", "root", "proof", "folded")]) for r in got), key=repr)
    lower = lambda t: t and "".join(c.lower() for c in t)
    assert got == _brute_manifest([(d, lang, (d, s, lang, t), (d, s, lang, lower(t) if d is not None and d % 3 == 0 else t)) for d, s, lang, t in rows])


def test_manifest_of_few_rows(spark):
    schema = "doc_id long, lang string"
    args = (F.col("lang"), F.col("doc_id"), [F.col("doc_id")], [F.col("doc_id")])
    assert merkle.manifest(spark.createDataFrame([], schema), *args).collect() == []
    (row,) = merkle.manifest(spark.createDataFrame([(7, None)], schema), *args).collect()
    leaf = _hash("1:7")
    assert [bytes(row[c]).hex() for c in ("leaf", "subroot", "root", "folded", "proof")] == [leaf] * 4 + [_hash()]


# 12
def _brute_negatives(rows, is_anchor, k=5, low=80, high=100):
    fine = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        value = (label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        if sum(x * x for x in value[1]) <= negatives.LARGEST:
            fine[i] = min(value, fine.get(i, value))
    score = lambda a, b: sum(x * y for x, y in zip(fine[a][1], fine[b][1]))
    out = []
    for a in (i for i in fine if is_anchor(i)):
        best = sorted((-score(a, i), i) for i in fine if i != a and fine[i][0] == fine[a][0])[:k]
        for s, p in best:
            inside = sorted((-n, i) for i in fine if fine[i][0] != fine[a][0] and low * -s <= 100 * (n := score(a, i)) <= high * -s)[:k]
            out += [(a, p, r, i, -s, -n) for r, (n, i) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(1024, 4096), (3, 17)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("ANCHORS", "ROWS"), blocks):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(12)
    centre = rng.normal(size=11)
    rows = [(k, int(rng.integers(0, 4)), [float(x) for x in (centre + 0.3 * rng.normal(size=11)).round(2)]) for k in range(200)]
    rows += [(k, 1 + k % 2, rows[20][2]) for k in range(200, 240)]  # ties: copies of an anchor's vector under two labels
    rows += [(240, 1, None), (241, 1, [1.0, None]), (242, 1, [float("nan")] * 3), (243, 1, [float("-inf")]), (244, None, [1.0]), (None, 1, [1.0])]
    rows += [(260, 2, [3.0]), (245, 2, []), (7, 0, rows[7][2]), (7, 3, rows[7][2]), (246, 2, [1e30]), (247, 1, [-1.0] * 11)]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "vec_id long, label int, embedding array<float>, rank string, id int")
    got = negatives.hard_negatives(df, F.col("vec_id") % 20 == 0, F.col("label")).collect()
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r[n] for n in names) for r in got) == _brute_negatives(rows, lambda i: i % 20 == 0)


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for rows in ([], [(0, 1, [1.0])], [(0, 1, None)], [(0, 1, []), (1, 1, []), (2, 2, [])]):
        got = negatives.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0, F.col("label")).collect()
        assert [(r.anchor_id, r.positive_id, r.negative_id) for r in got] == ([(0, 1, 2)] if len(rows) == 3 else [])


def test_scores_by_tables_are_inner_products():
    rng = np.random.default_rng(1)
    for bits in (1, 2, 9, 20):
        x, a = (rng.integers(-(1 << bits - 1), 1 << bits - 1, (n, 24)) for n in (50, 7))
        assert (negatives.scores_of(negatives.planes_of(x, bits), negatives.subset_sums(a, np.int64)) == a @ x.T).all()


# 13
def _trees_match(a, b):
    """Simple tree matching by trying every ordered choice of pairs."""
    if a.label != b.label:
        return 0

    def most(x, y):
        if not x or not y:
            return 0
        return max(most(x[1:], y), most(x, y[1:]), (_trees_match(x[0], y[0]) + most(x[1:], y[1:])) if x[0].label == y[0].label else 0)

    return 1 + most(a.kids, b.kids)


def test_tree_matching_equals_brute_force():
    rng = random.Random(13)

    def tree(depth):
        return wrappers.Slot(rng.choice("ab") if depth < 3 else "r", 0, kids=[tree(depth - 1) for _ in range(rng.randrange(4))] if depth else [])

    for _ in range(200):
        a, b = tree(3), tree(3)
        assert wrappers.matching(a, b) == _trees_match(a, b)
        nodes = sum(1 for _ in a.walk()) + sum(1 for _ in b.walk())
        pairs = wrappers.matching(a, b)
        wrappers.merge(a, b)
        # every node is there once; folding neighbours of one label can only pair more
        assert sum(1 for _ in a.walk()) <= nodes - pairs and a.pages == 2


def _sentences(rng, n):
    return [" ".join(rng.choice(["alpha", "beta", "gämma", "delta", "the", "of"]) + str(rng.randrange(99)) for _ in range(rng.randrange(5, 25))) + "." for _ in range(n)]


def _page(rng, style, k):
    """(html, main text) of a page of a host whose template is ``style``."""
    body = _sentences(rng, rng.randrange(1, 9))
    title = f"Title {k} &amp; more"
    noise = _sentences(rng, 3)
    menu = "".join(f'<a href="/{rng.randrange(9)}">Item {rng.randrange(99)}</a>' for _ in range(6))
    want = [f"Title {k} & more", *body]
    cut = "".join(f"<p>{s.replace(' ', ' &nbsp;', 1)}" + ("</p>" if rng.random() < 0.5 else "") for s in body)
    if style == "semantic":
        html = f"<html><head><title>x</title><style>p{{}}</style></head><body><nav><ul><li>{menu}</ul></nav><article><header><h1>{title}</h1></header>{cut}<div class=share>Share this</div><section id='comments'><article class=comment><p>{noise[0]}</article></section></article><aside>{noise[1]}</aside><footer>{noise[2]}</footer></body></html>"
    elif style == "classes":
        html = f'<body class="has-sidebar"><div id="page-header"><p>Site</p></div><div class="wrap"><div class="post-body"><h1>{title}</h1>{cut}</div><div class="right-sidebar"><p>{noise[0]}</p></div></div><div class="cookieNotice">We use cookies</div><form><input>Search <button>Go</button></form><script>var a="<p>no</p>";</script></body>'
    elif style == "plain":  # nothing is named: links, size and constancy tell
        html = f"<body><div>{menu}</div><div><h1>{title}</h1>{cut}<p>Read our newsletter every day for more.</p></div><div><p>Impressum and terms</p></div></body>"
    else:  # tables
        html = f"<table><tr><td>{menu}<td><h1>{title}</h1>{cut}<p class='ad-box'>{noise[0]}</p></table><!-- <p>off</p> --><p hidden>{noise[1]}"
    return html, " ".join(want)


def test_main_texts_of_generated_hosts(spark):
    rng = random.Random(31)
    rows, want = [], {}
    for style in ("semantic", "classes", "plain", "tables"):
        for k in range(40):
            page = len(rows)
            html, want[page] = _page(rng, style, k)
            rows.append((page, f"https://User@{style}.example.org:80/{k}?q=1", html))
    copy = rows[5]
    rows += [(1000 + k, copy[1], copy[2]) for k in range(20)]  # copies are no evidence
    want |= {1000 + k: want[5] for k in range(20)}
    odd = [None, "", "plain text", "<p>cut of", "<", "<p>" + "long " * 40_000, "<div>" * 3000 + "deep", "<b>" * 3000 + "x", '<p class="']
    rows += [(2000 + k, None, h) for k, h in enumerate(odd)]
    want |= dict(zip(range(2000, 2009), ["", "", "plain text", "cut of", "<", ("long " * 40_000).strip(), "deep", "x", ""]))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, wrapper int").repartition(7)
    got = {r.page_id: (r.text, r.n_chars) for r in wrappers.main_texts(df).collect()}
    assert {k: t for k, (t, _) in got.items()} == want
    assert all(n == len(t) for t, n in got.values())
    assert wrappers.main_texts(df.limit(0)).count() == 0
    assert wrappers.main_texts(df.where("page_id IS NULL OR page_id < 3").union(df.where("page_id = 1"))).count() == 4


def test_decisions_do_not_depend_on_the_split(spark):
    """The same texts whether a host's pages come in one part or in many."""
    rng = random.Random(32)
    rows = [(k, f"http://h{k % 2}.org/{k}", _page(rng, ("plain", "classes")[k % 2], k)[0]) for k in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [sorted(tuple(r) for r in wrappers.main_texts(df.repartition(n)).collect()) for n in (1, 13)]
    assert got[0] == got[1]


# 2, whole near-duplicates
def _mutated(rng, words, share):
    return [f"other{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def test_near_duplicates_equal_brute_force_around_the_limit(spark):
    """Pairs whose five-word Jaccard similarity lies around 0.8: each is linked if and only if it reaches 0.8."""
    rng = random.Random(21)
    texts = {}
    for k in range(150):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 200, 600]))]
        texts[2 * k] = " ".join(words)
        texts[2 * k + 1] = " ".join(_mutated(rng, words, rng.uniform(0.005, 0.09)))
    sets = {k: frozenset(simhash.shingle_set(t, 5).tolist()) for k, t in texts.items()}
    df = spark.createDataFrame([(k, t, 0) for k, t in texts.items()], "doc_id long, text string, component_id int").repartition(5)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    alike = {k: len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) for k in range(150)}
    linked = {k: got[2 * k + 1] == 2 * k for k in range(150)}
    assert not [k for k in range(150) if linked[k] and alike[k] < 0.8]
    reach = [k for k in range(150) if alike[k] >= 0.8]
    assert sum(linked[k] for k in reach) >= 0.98 * len(reach) and 40 < len(reach) < 110
    assert all(got[2 * k] == 2 * k for k in range(150))


def test_near_duplicates_of_a_hot_group(spark, monkeypatch):
    """Chains through rows that the smallest one is not similar to; copies, texts without words and repeated ids."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(22)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    chain, words = [], base
    for k in range(12):  # neighbours are similar, ends are not
        chain.append(" ".join(words))
        words = [f"c{k}x{i}" if 20 * k <= i < 20 * k + 12 else w for i, w in enumerate(words)]
    texts = [*chain, *chain[:3], *[" ".join(_mutated(rng, base, 0.01)) for _ in range(60)], "", None, " ", "one two", "two one"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(0, chain[0]), (None, chain[0])]
    got = {}
    for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert got.setdefault(r.doc_id, r.component_id) == r.component_id
    assert None not in got and set(got) == set(range(len(texts)))
    sets = [frozenset(simhash.shingle_set(t, 5).tolist()) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (not sets[i] and not sets[j]) or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    assert [got[k] for k in range(len(texts))] == label


def test_a_wrapper_keeps_the_slots_of_single_pages():
    """However many slots a host has: what is known of it does not change with its size."""
    import json

    import pyarrow as pa

    from silverlode.llm import wrappers

    def merged(pages: list[wrappers.Slot]) -> list[str]:
        made = [json.dumps(page.packed()) for page in pages]
        found = wrappers._merged(pa.table({"host": ["h"] * len(made), "wrapper": made}))
        return [s.label for s in wrappers.unpacked(json.loads(found["wrapper"][0].as_py())).walk()]

    for n in (3, 2500):
        page = wrappers.Slot("page", 0, kids=[wrappers.Slot(f"div.q{k}", 0) for k in range(n)])
        other = wrappers.Slot("page", 0, kids=[wrappers.Slot("p", 0)])
        assert {f"div.q{k}" for k in range(n)} | {"p"} <= set(merged([page, other]))
