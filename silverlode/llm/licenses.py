"""License scan: ordered signature rules over a text's words, gated by keywords, with overlaps resolved.

A text is lower-cased (A-Z only) and reduced to its words, joined by single spaces.  Each rule is a regular expression
over that form with a label, a priority (smaller is stronger) and a confidence.  A text without any gate keyword passes
untouched; for the others a rule runs only if its own keyword occurs.

Detections are sorted by start, then longest, then priority; one that lies within an earlier one is suppressed, and so
is one that overlaps the last kept one and has no higher priority.  What is left gives the labels and the score, one less
the product of (1 - confidence) over the labels kept.  The sweep is linear in the number of detections of a text.

Base phrases are counted separately: every place where their words stand consecutively.  Their labels are never
suppressed.  Everything is built-in functions on the row itself: no shuffle, and one row never meets another.

Results: null counts as empty: no words, no labels, score 0; ties are settled by the sort above; repeated rows are
scanned alike; an empty table gives an empty table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The phrases whose places are counted, and their labels (fixed values).
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


# Each license's label, a keyword that every form of its name holds, its name and its SPDX id as words.
_NAMES = (
    ("mit", "mit", "mit", "mit"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: version)? (?:v ?)?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version)? (?:v ?)?1 1", "apache 1 1"),
    ("apache", "apache", "apache(?: software)?", "apache"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public license(?: version)? (?:v ?)?2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public license(?: version)? (?:v ?)?3(?: 0)?", "gpl 3 0"),
    ("gpl", "general public", "(?:gnu )?general public", "gpl"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license(?: version)? (?:v ?)?2 1", "lgpl 2 1"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public license(?: version)? (?:v ?)?3(?: 0)?", "lgpl 3 0"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public", "lgpl"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: version)? (?:v ?)?3(?: 0)?", "agpl 3 0"),
    ("agpl", "affero", "(?:gnu )?affero general public", "agpl"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    ("bsd", "bsd", "bsd", "bsd"),
    ("isc", "isc", "isc", "isc"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version)? (?:v ?)?1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version)? (?:v ?)?2(?: 0)?", "mpl 2 0"),
    ("mpl", "mozilla", "mozilla public", "mpl"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version)? (?:v ?)?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version)? (?:v ?)?2(?: 0)?", "epl 2 0"),
    ("cddl-1.0", "common development", "common development and distribution", "cddl 1 0"),
    ("cpl-1.0", "common public", "common public", "cpl 1 0"),
    ("eupl-1.2", "european union", "european union public", "eupl 1 2"),
    ("artistic-2.0", "artistic", r"artistic license 2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", "artistic", "artistic"),
    ("boost-1.0", "boost", "boost software", "bsl 1 0"),
    ("zlib", "zlib", "zlib", "zlib"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "(?:wtfpl|do what the fuck you want to public)", "wtfpl"),
    ("python-2.0", "python", "python(?: software foundation)?", "psf 2 0"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("ofl-1.1", "open font", r"(?:sil )?open font license(?: version)? 1 1", "ofl 1 1"),
    ("ms-pl", "microsoft", "microsoft public", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal", "ms rl"),
    ("odbl-1.0", "open database", "open database", "odbl 1 0"),
    ("gfdl", "documentation", "(?:gnu )?free documentation", "gfdl"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
)
_CLAUSES = (("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:ative)?s"),
            ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
            ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s"))
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# Sentences of license texts and of notices that name no license.
_SENTENCES = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2.0", "apache", r"you may not use this file except in compliance with the license .{0,80}apache"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("all-rights-reserved", "all rights reserved", r"all rights reserved"),
    ("copyleft", "copyleft", r"copyleft"),
)


def _rules() -> tuple[Rule, ...]:
    """Signatures by form: an SPDX tag, a notice, the name with ``license``, and sentences; strongest first."""
    names = list(_NAMES)
    for code, words in _CLAUSES:
        short = code.replace("-", " ")
        names += [(f"cc-{code}-{v.replace(' ', '.')}", short.split()[0], rf"(?:cc {short}|creative commons {words})(?: license)?(?: version)? {v}", f"cc {short} {v}") for v in _CC_VERSIONS]
        names.append((f"cc-{code}", short.split()[0], rf"(?:cc {short}|creative commons {words})", f"cc {short}"))
    out = []
    for label, keyword, name, tag in names:
        out.append(Rule(label, "spdx", rf"spdx license identifier {tag}(?: only| or later)?", 1, 0.99))
        out.append(Rule(label, keyword, rf"(?:licensed|released|distributed|available|provided|covered|published) under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?(?: version [0-9]+(?: [0-9]+)?)?", 2, 0.95))
        out.append(Rule(label, keyword, rf"{name} licen[cs]e", 3, 0.8))
    out += [Rule(label, keyword, sentence, 2, 0.9) for label, keyword, sentence in _SENTENCES]
    return tuple(out)


RULES = _rules()
#: A text without any of these (in lower case) holds no base phrase and matches no rule: every pattern needs one of them.
GATE = ("licen", "spdx", "released", "distributed", "available", "provided", "covered", "published",
        "permission", "redistribut", "domain", "reserved", "copyleft")
#: Runs of word characters in a text that is not lower-cased yet.
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_form(text: Column) -> Column:
    """The words of ``text``, each after one space, and a last space."""
    spaced = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))


def _has_any(text: Column, keywords: tuple[str, ...]) -> Column:
    lower, found = F.lower(text), F.lit(False)
    for k in keywords:
        found = found | F.contains(lower, F.lit(k))
    return F.coalesce(found, F.lit(False))


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)))

    def stands(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + k) == part)
        return F.coalesce(found, F.lit(False))

    return F.filter(starts, stands)


_KIND = "array<struct<start:int,back:int,priority:int,rule:int>>"


def _table(rules: tuple[Rule, ...]) -> Column:
    """The rules as one constant array, so that the plan does not grow with their number."""
    rows = [{"keyword": r.keyword, "pattern": f"(?<= ){r.pattern}(?= )", "priority": r.priority, "rule": k} for k, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<keyword:string,pattern:string,priority:int,rule:int>>")


def _detections(form: Column, rules: tuple[Rule, ...]) -> Column:
    """(start, -end, priority, rule number) of every match, in characters of the words form."""

    def matches(rule: Column) -> Column:
        pieces, found = F.split(form, rule["pattern"], -1), F.regexp_extract_all(form, rule["pattern"], F.lit(0))
        pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.struct(p.alias("piece"), m.alias("found")))

        def step(acc: Column, pair: Column) -> Column:
            begin = acc["at"] + F.length(pair["piece"])
            end = begin + F.length(pair["found"])
            one = F.struct(begin.alias("start"), (-end).alias("back"), rule["priority"].alias("priority"), rule["rule"].alias("rule"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(_KIND).alias("out")), step, lambda acc: acc["out"])

    return F.flatten(F.transform(F.filter(_table(rules), lambda rule: F.contains(form, rule["keyword"])), matches))


def _kept(detections: Column) -> Column:
    """Numbers of the rules that have a detection left, by one sweep over the sorted detections."""
    start = F.struct(F.lit(0).alias("end"), F.lit(99).alias("priority"), F.array().cast("array<int>").alias("rules"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["back"]
        drop = (end <= acc["end"]) | ((d["start"] < acc["end"]) & (d["priority"] >= acc["priority"]))
        rules = F.when(F.array_contains(acc["rules"], d["rule"]), acc["rules"]).otherwise(F.concat(acc["rules"], F.array(d["rule"])))
        kept = F.struct(end.alias("end"), d["priority"].alias("priority"), rules.alias("rules"))
        return F.when(drop, acc).otherwise(kept)

    return F.aggregate(F.sort_array(detections), start, step, lambda acc: acc["rules"])


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, gate: tuple[str, ...] = GATE, base=BASE) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels and score; existing ones are replaced."""
    rows = docs.withColumn("_form", F.when(_has_any(F.col(text), gate), words_form(F.col(text))))
    rows = rows.withColumn("n_words", F.coalesce(F.regexp_count(text, F.lit(_RAW_WORD)), F.lit(0)).cast("long"))
    rows = rows.withColumn("_words", F.split(F.trim("_form"), " "))
    for k, (phrase, _) in enumerate(base):
        near = F.contains(F.col("_form"), F.lit(f" {phrase} "))
        rows = rows.withColumn(f"_base{k}", F.when(F.col("_words").isNotNull() & near, _places(F.col("_words"), phrase)).otherwise(F.array().cast("array<int>")))
    places = F.flatten(F.array(*[F.col(f"_base{k}") for k in range(len(base))]))
    rows = rows.withColumn("n_base", F.size(places).cast("long")).withColumn("first_word", F.array_min(places).cast("long")).withColumn("last_word", F.array_max(places).cast("long"))
    base_labels = F.filter(F.array(*[F.when(F.size(f"_base{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(base)]), lambda x: x.isNotNull())
    found = _detections(F.col("_form"), rules)
    rows = rows.withColumn("_rules", F.when(F.col("_words").isNotNull(), _kept(found)).otherwise(F.array().cast("array<int>")))
    table = F.array(*[F.lit(r.label) for r in rules])
    doubt = F.array(*[F.lit(1 - r.confidence) for r in rules])
    rows = rows.withColumn("_base", base_labels).withColumn("_own", F.transform("_rules", lambda r: F.get(table, r)))
    rows = rows.withColumn("base_labels", F.array_join(F.sort_array(F.array_distinct("_base")), ","))
    rows = rows.withColumn("labels", F.array_join(F.sort_array(F.array_distinct(F.concat("_base", "_own"))), ","))
    left = F.aggregate(F.transform("_rules", lambda r: F.get(doubt, r)), F.when(F.col("n_base") > 0, F.lit(0.2)).otherwise(F.lit(1.0)), lambda a, x: a * x)
    rows = rows.withColumn("score", 1 - left)
    return rows.drop("_form", "_words", "_rules", "_base", "_own", *[f"_base{k}" for k in range(len(base))])
