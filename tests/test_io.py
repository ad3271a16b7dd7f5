import bz2
import json
import os
import threading

import pytest

from tests.scalar_text import cleaned
from threadtone import schemas
from threadtone.plans.cleaning import clean_bodies
from threadtone.session import shared_folder
from threadtone.sources import readers, writers
from threadtone.sources.materialize import fingerprint, materialize
from threadtone.sources.writers import (
    write_csv_file,
    write_csv_files,
    write_csv_folder,
    write_then_read,
)


def write_lines(path, rows):
    opener = bz2.open if str(path).endswith(".bz2") else open
    with opener(path, "wt", encoding="utf8") as out:
        for row in rows:
            out.write((row if isinstance(row, str) else json.dumps(row)) + "\n")
    return str(path)


def test_labeled_csv_is_all_text(spark, tmp_path):
    path = write_lines(
        tmp_path / "labeled.csv",
        ["Input_id,labeldem,labelgop,labeldjt", "a,1,-1,0", "b,,1.0,x"],
    )
    df = readers.read_labeled(spark, path)
    assert {kind for _, kind in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.collect()] == [("a", "1", "-1", "0"), ("b", None, "1.0", "x")]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = write_lines(tmp_path / "l.csv", ["note,Input_id,labeldjt,labeldem,labelgop", "n,x,1,-1,0"])
    assert readers.read_labeled(spark, path).collect() == [("x", "-1", "0", "1")]
    with pytest.raises(ValueError, match="labelgop"):
        readers.read_labeled(spark, write_lines(tmp_path / "m.csv", ["Input_id,labeldem,labeldjt", "x,1,1"]))
    other = write_lines(tmp_path / "o.csv", ["Input_id,labeldem,labelgop,labeldjt,note", "y,1,1,1,n"])
    with pytest.raises(Exception, match="header"):
        readers.read_labeled(spark, [path, other]).collect()


def test_json_numbers_in_any_form(spark, tmp_path):
    rows = [
        {"id": "a", "created_utc": "1510012800", "score": 5.0},
        {"id": "b", "created_utc": 1.5100128e9, "score": " -7 "},
        {"id": "c", "created_utc": "soon", "score": None},
        {"id": "d", "created_utc": 1510012800, "score": 3},
    ]
    path = write_lines(tmp_path / "c.json", rows)
    got = readers.read_comments(spark, [path]).select("id", "created_utc", "score").collect()
    assert [tuple(r) for r in got] == [
        ("a", 1510012800, 5), ("b", 1510012800, -7), ("c", None, None), ("d", 1510012800, 3),
    ]
    lost = readers.unreadable(spark, path, schemas.COMMENTS).first()
    assert (lost.created_utc, lost.score, lost.id) == (1, 0, 0)


def test_comments_json_bz2(spark, tmp_path):
    rows = [
        {"id": "c1", "body": "x\ny", "link_id": "t3_s", "created_utc": 5, "score": -2,
         "author_flair_text": "Ohio", "unused": {"a": 1}},
        {"id": "c2"},
        "no json",
    ]
    df = readers.read_comments(spark, write_lines(tmp_path / "c.json.bz2", rows))
    assert df.schema == schemas.COMMENTS
    assert [tuple(r) for r in df.collect()] == [
        ("c1", "x\ny", "t3_s", 5, -2, "Ohio"),
        ("c2", None, None, None, None, None),
        (None,) * 6,
    ]


@pytest.mark.parametrize("name", ["bodies.json", "bodies.json.bz2"])
def test_clean_bodies(spark, tmp_path, name):
    texts = ["Hello, world... yes", "see http://x.y now", "", "café -- [a](b)"]
    path = write_lines(tmp_path / name, [*({"body": t, "id": "1"} for t in texts), '{"body": "cut'])
    quarantine = str(tmp_path / "quarantine")
    got = {tuple(r) for r in clean_bodies(spark, path, quarantine).collect()}
    assert got == {cleaned(t) for t in texts}
    (lost,) = spark.read.parquet(quarantine).collect()
    assert lost.file.endswith(name) and lost.record == '{"body": "cut'


def test_malformed_json_is_kept_apart(spark, tmp_path):
    good = [{"id": "a", "score": "7"}, {"id": "b"}, {}]
    one = write_lines(tmp_path / "one.json", [good[0], "no json", '{"id": "c"', good[1], "5"])
    two = write_lines(tmp_path / "two.json.bz2", ['"text"', good[2], ""])
    checked = write_then_read(
        readers.checked_json(spark, [one, two], schemas.SUBMISSIONS), str(tmp_path / "checked")
    )
    rows = readers.accepted(checked)
    assert rows.schema == schemas.SUBMISSIONS
    assert sorted(map(tuple, rows.collect()), key=repr) == [("a", 7), ("b", None), (None, None)]
    lost = sorted((r.file.rsplit("/", 1)[1], r.record) for r in readers.rejected(checked).collect())
    assert lost == [("one.json", "5"), ("one.json", "no json"), ("one.json", '{"id": "c"'), ("two.json.bz2", '"text"')]
    counts = {r.file.rsplit("/", 1)[1]: r.records for r in readers.rejected_by_file(checked).collect()}
    assert counts == {"one.json": 3, "two.json.bz2": 1}


def test_malformed_csv_is_kept_apart(spark, tmp_path):
    lines = ["note,Input_id,labeldem,labelgop,labeldjt", "n,a,1,-1,0", "short,b", "n,c,1,1,1,9", "n,d,,,"]
    path = write_lines(tmp_path / "l.csv", lines)
    checked = write_then_read(readers.checked_csv(spark, path, schemas.LABELED), str(tmp_path / "checked"))
    assert [r.Input_id for r in readers.accepted(checked).collect()] == ["a", "d"]
    assert sorted(r.record for r in readers.rejected(checked).collect()) == ["n,c,1,1,1,9", "short,b"]
    with pytest.raises(ValueError, match="labelgop"):
        readers.checked_csv(spark, write_lines(tmp_path / "m.csv", ["Input_id,labeldem,labeldjt", "x,1,1"]), schemas.LABELED)


def test_csv_file_has_its_name_a_header_and_sorted_rows(spark, tmp_path):
    path = str(tmp_path / "time_data.csv")
    df = spark.createDataFrame([(3, 0.3), (1, 0.1), (2, None)], "k int, v double").repartition(3)
    for _ in range(2):  # the second write replaces the first
        write_csv_file(df, path, ["k"])
    assert os.path.isfile(path)
    assert open(path).read() == "k,v\n1,0.1\n2,\n3,0.3\n"
    assert [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["time_data.csv"]


def test_csv_files_by_value(spark, tmp_path):
    df = spark.createDataFrame(
        [("b", 2, 0.2), ("a", 3, 0.3), ("a", 1, 0.1), ("z", 9, 0.9)], "t string, k int, v double"
    ).repartition(3)
    paths = {t: str(tmp_path / f"{t}_x.csv") for t in ("a", "b", "none")}
    for _ in range(2):
        write_csv_files(df, "t", paths, ["k"])
    assert open(paths["a"]).read() == "k,v\n1,0.1\n3,0.3\n"
    assert open(paths["b"]).read() == "k,v\n2,0.2\n"
    assert open(paths["none"]).read() == "k,v\n"
    assert len([f for f in os.listdir(tmp_path) if not f.startswith(".")]) == 3


def test_empty_csv_file_keeps_its_header(spark, tmp_path):
    path = str(tmp_path / "empty.csv")
    write_csv_file(spark.createDataFrame([], "k int, v double"), path, ["k"])
    assert open(path).read() == "k,v\n"


def test_csv_folder_roundtrip(spark, tmp_path):
    path = str(tmp_path / "shares")
    df = spark.createDataFrame([("Utah", 0.25, 1 / 3), ("Ohio", 1.0, 0.0)], schemas.STATE_DATA)
    write_csv_folder(df, path, ["state"])
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    back = readers.read_csv(spark, path, schemas.STATE_DATA).collect()
    assert [tuple(r) for r in back] == [("Ohio", 1.0, 0.0), ("Utah", 0.25, 1 / 3)]


def test_write_then_read_reads_files(spark, tmp_path):
    stored = write_then_read(spark.range(5), str(tmp_path / "t"))
    assert stored.inputFiles() and stored.count() == 5


def test_materialize_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    first = materialize(spark, "t", build, "k1", str(tmp_path))
    second = materialize(spark, "t", build, "k1", str(tmp_path))
    assert len(calls) == 1 and first.count() == second.count() == 3
    materialize(spark, "t", build, "k2", str(tmp_path))
    assert len(calls) == 2


def test_materialize_repeats_an_unfinished_write(spark, tmp_path):
    materialize(spark, "t", lambda: spark.range(3), "k", str(tmp_path))
    os.remove(tmp_path / "t-k" / "_SUCCESS")
    again = materialize(spark, "t", lambda: spark.range(4), "k", str(tmp_path))
    assert again.count() == 4


def test_two_builders_share_the_first_table(spark, tmp_path):
    """Both are past the look for the table before either has written it."""
    both, tables, errors = threading.Barrier(2), {}, []

    def work(n):
        def build():
            both.wait(30)
            return spark.range(n)

        try:
            tables[n] = [r.id for r in materialize(spark, "t", build, "k", str(tmp_path)).collect()]
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=work, args=(n,)) for n in (3, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(60)
    assert not errors
    assert sorted(tables[3]) == sorted(tables[5]) and len(tables[3]) in (3, 5)
    assert os.listdir(tmp_path) == ["t-k"]


def test_a_table_that_is_read_is_not_replaced(spark, tmp_path):
    first = materialize(spark, "t", lambda: spark.range(4), "k", str(tmp_path))
    os.rename(tmp_path / "t-k", tmp_path / "aside")

    def build():  # another builder finishes meanwhile
        os.rename(tmp_path / "aside", tmp_path / "t-k")
        return spark.range(9)

    second = materialize(spark, "t", build, "k", str(tmp_path))
    assert first.count() == second.count() == 4


class Broken(Exception):
    pass


def publish_two(spark, folder, value, fail=False):
    def write(stage):
        paths = [f"{stage}/a.csv", f"{stage}/b.csv"]
        write_csv_file(spark.createDataFrame([(value,)], "v int"), paths[0], ["v"])
        if fail:
            raise Broken
        write_csv_file(spark.createDataFrame([(value,)], "v int"), paths[1], ["v"])
        return paths

    return writers.published_together(spark, folder, write)


def contents(folder):
    return {f: open(folder / f).read() for f in os.listdir(folder) if not f.startswith(".")}


def test_files_are_all_new_or_all_old(spark, tmp_path, monkeypatch):
    folder = tmp_path / "out"
    (tmp_path / "out").mkdir()
    (folder / "other.txt").write_text("mine")
    assert publish_two(spark, str(folder), 1) == [f"{folder}/a.csv", f"{folder}/b.csv"]
    with pytest.raises(Broken):
        publish_two(spark, str(folder), 2, fail=True)
    old = {"a.csv": "v\n1\n", "b.csv": "v\n1\n", "other.txt": "mine"}
    assert contents(folder) == old

    # The job dies between two moves; whoever comes next does the rest.
    real, calls = writers.moved, []

    def dies(spark, source, target, replace=False):
        if target.endswith(("out/a.csv", "out/b.csv")):
            calls.append(target)
            if len(calls) == 2:
                raise Broken
        return real(spark, source, target, replace)

    monkeypatch.setattr(writers, "moved", dies)
    with pytest.raises(Broken):
        publish_two(spark, str(folder), 3)
    monkeypatch.setattr(writers, "moved", real)
    writers.finish_publication(spark, str(folder))
    assert contents(folder) == old | {"a.csv": "v\n3\n", "b.csv": "v\n3\n"}


def test_a_failing_third_table_leaves_the_old_files(spark, tmp_path, monkeypatch):
    from threadtone.plans import publishing

    rows = [(0, "l", "c", "Ohio", 1, 0, 5, 50), (86400, "l", "d", "Utah", 0, 1, 6, 60)]
    kinds = "timestamp bigint, link_id string, comment_id string, state string, a_pos int, a_neg int, c_score bigint, s_score bigint"
    df, folder = spark.createDataFrame(rows, kinds), tmp_path / "out"
    written = publishing.publish(df, ["a"], str(folder), unprefixed="a")
    assert len(written) == 4 and all(map(os.path.isfile, written))
    before, real, calls = contents(folder), publishing.write_csv_files, []

    def fails(*args):
        calls.append(args)
        if len(calls) == 3:
            raise Broken
        return real(*args)

    monkeypatch.setattr(publishing, "write_csv_files", fails)
    with pytest.raises(Broken):
        publishing.publish(df.where("state = 'Ohio'"), ["a"], str(folder), unprefixed="a")
    assert contents(folder) == before
    monkeypatch.setattr(publishing, "write_csv_files", real)
    publishing.publish(df.where("state = 'Ohio'"), ["a"], str(folder), unprefixed="a")
    after = contents(folder)
    assert set(after) == set(before) and all(after[f] != before[f] for f in before)


def test_materialize_lets_errors_surface(spark, tmp_path):
    def build():
        return spark.read.parquet(str(tmp_path / "absent"))

    with pytest.raises(Exception, match="absent"):
        materialize(spark, "t", build, "k", str(tmp_path))


def test_fingerprint_follows_inputs_and_parameters(spark, tmp_path):
    path = write_lines(tmp_path / "in.json", [{"body": "x"}])
    one = fingerprint(spark, [path], {"p": 1})
    assert one == fingerprint(spark, [path], {"p": 1})
    assert one != fingerprint(spark, [path], {"p": 2})
    write_lines(tmp_path / "in.json", [{"body": "longer"}])
    assert one != fingerprint(spark, [path], {"p": 1})


def test_fingerprint_sees_every_file(spark, tmp_path):
    nested = tmp_path / "in" / "a" / "b"
    nested.mkdir(parents=True)
    path = write_lines(nested / "x.json", ["1"])
    write_lines(nested / "y.json", ["2"])
    folder, pattern = str(tmp_path / "in"), str(tmp_path / "in" / "*")
    before = fingerprint(spark, [folder], {}), fingerprint(spark, [pattern], {})
    write_lines(nested / "x.json", ["7"])
    os.utime(path, (1, 1))
    after = fingerprint(spark, [folder], {}), fingerprint(spark, [pattern], {})
    assert before[0] != after[0] and before[1] != after[1]
    with pytest.raises(FileNotFoundError):
        fingerprint(spark, [str(tmp_path / "absent*")], {})


def test_two_parts_are_an_error(spark, tmp_path):
    folder = tmp_path / "t"
    spark.range(4).repartition(2).write.csv(str(folder))
    with pytest.raises(RuntimeError, match="2 part files"):
        writers._move_part(spark, str(folder), str(tmp_path / "t.csv"))


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_spread_leaves_well_split_scans_alone(spark, testdata):
    wide = spark.range(0, 1000, 1, 8)
    assert readers.spread(wide) is wide
    documents = spark.read.parquet(f"{testdata}/documents.parquet")
    assert readers.spread(documents).rdd.getNumPartitions() == 12
