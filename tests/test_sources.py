import pytest
from support import rows

from silverlode.catalog import CSV_COMMA, CSV_PIPE, DEFAULT, JSON_ARRAY
from silverlode.config import ConfigError, FileFormat
from silverlode.session import scratch_root
from silverlode.sources import files


def test_comma_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('X,Y,Z\n1,"a, ""b""",\\N\n2,, c \n')
    df = files.read_delimited(spark, str(path), ["p", "q", "r"], CSV_COMMA)
    assert rows(df) == [("1", 'a, "b"', None), ("2", None, " c ")]


def test_pipe_csv_trims_and_allows_ragged_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("X|Y|Z\n 1 |NULL|null\n2|b\n3|c|d|surplus\n")
    df = files.read_delimited(spark, str(path), ["p", "q", "r"], CSV_PIPE)
    assert rows(df) == [("1", None, None), ("2", "b", None), ("3", "c", "d")]


def test_json_array_over_several_lines(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[\n {"p": "1", "q": "NULL"},\n {"p": "2", "q": "x"}\n]')
    df = files.read_json(spark, str(path), files.text_schema(["p", "q"]), JSON_ARRAY, whole_file=True)
    assert rows(df) == [("1", None), ("2", "x")]


def test_pattern_and_unknown_formats(spark, tmp_path):
    (tmp_path / "order_1.csv").write_text("h\n1\n")
    (tmp_path / "skip_1.csv").write_text("h\n2\n")
    df = files.read_delimited(spark, str(tmp_path), ["p"], CSV_COMMA, "order_*.csv")
    assert rows(df) == [("1",)]
    assert [r.length for r in files.discover(spark, str(tmp_path), "order_*.csv").collect()] == [4]
    with pytest.raises(ConfigError):
        FileFormat(kind="XML")
    with pytest.raises(ConfigError):
        files.read_source(spark, DEFAULT.source("ORDER_STREAM"), str(tmp_path))


def test_scratch_folder_is_local_only_without_a_shared_one():
    class Context:
        master, applicationId = "spark://somewhere", "x"

    class Conf:
        value = None

        def get(self, _key, _default):
            return self.value

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        scratch_root(Session())
    Session.conf.value = "hdfs://shared/folder/"
    assert scratch_root(Session()) == "hdfs://shared/folder"
    Session.conf.value, Context.master = None, "local[2]"
    assert scratch_root(Session()).startswith("/tmp/run-")
