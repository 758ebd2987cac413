"""The commit log under failed writers, crashes and two writers; the streamed split digest."""

import hashlib
import random
from concurrent.futures import ThreadPoolExecutor

import pytest

from tesserine.operators.splits import split_digest
from tesserine.sources import commits, sheets, sinks


def put(spark, n):
    return lambda path: spark.range(n).write.parquet(f"{path}/t")


def rows(spark, root):
    return spark.read.parquet(f"{commits.current(spark, root)}/t").count()


def test_failed_writes_and_crashes_keep_the_old_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    commits.replace(spark, root, put(spark, 3))

    def fails(path):
        put(spark, 5)(path)
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        commits.replace(spark, root, fails)
    assert rows(spark, root) == 3 and len(list((tmp_path / "out/_data").iterdir())) == 1
    # a crash between the claim of a number and its entry
    with monkeypatch.context() as m:
        m.setattr(commits.Store, "_complete", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            commits.replace(spark, root, put(spark, 7))
    assert rows(spark, root) == 3 and commits.Store(spark, root).numbers() == [1, 2]
    # a crash in the middle of an entry
    (tmp_path / "out/_log/0000000002").write_text('{"op": "repl')
    assert rows(spark, root) == 3
    assert commits.replace(spark, root, put(spark, 5)) == 3 and rows(spark, root) == 5
    commits.replace(spark, root, put(spark, 6))
    assert rows(spark, root) == 6
    assert len([e for e in commits.Store(spark, root).entries()]) == 3


def test_check_and_set(spark, tmp_path):
    root = str(tmp_path / "out")
    first = commits.replace(spark, root, put(spark, 1), after=0)
    store = commits.Store(spark, root)
    mine, theirs = store.stage(put(spark, 2)), store.stage(put(spark, 3))
    assert store.commit("replace", theirs, after=first) == 2
    with pytest.raises(commits.Conflict):
        store.commit("replace", mine, after=first)
    assert rows(spark, root) == 3


def test_many_appenders_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "trials")
    one = lambda k: spark.createDataFrame([(k,)], "k int")
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda k: sinks.append_trial(one(k), root), range(18)))
    assert sorted(numbers) == list(range(1, 19))
    assert sorted(r.k for r in commits.read(spark, root).collect()) == list(range(18))
    commits.replace(spark, root, lambda path: one(99).write.parquet(path))
    sinks.append_trial(one(100), root)
    assert sorted(r.k for r in commits.read(spark, root).collect()) == [99, 100]


def test_plain_folders_are_read_as_before(spark, tmp_path):
    tables = {t: spark.range(2) for t in sheets.MANIFEST} | {"split": spark.createDataFrame([("v", "p")], "split_version string, patient_id string"), "split_definitions": spark.createDataFrame([("v", "d")], "split_version string, description string")}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / "m" / name))
    assert sheets.read_manifest(spark, str(tmp_path / "m"))["split"].count() == 1


@pytest.mark.parametrize("most", [10_000, 3])
def test_digest_is_that_of_one_string(spark, most):
    r = random.Random(0)
    data = [(f, c, f"p{r.randrange(10**6)}é") for f in ("a", "b") for c in ("fit", "test", "validate") for _ in range(r.randrange(1, 60))] + [("a", None, "x"), ("b", "fit", None)]
    want = {}
    for f in ("a", "b"):
        text = ";".join(f"{c}:{','.join(sorted((p for g, d, p in data if (g, d) == (f, c) and p), key=str.encode))}" for c in ("fit", "test", "validate"))
        want[f] = hashlib.sha256(text.encode()).hexdigest()[:16]
    frame = spark.createDataFrame(data, "field string, category string, patient_id string").repartition(5)
    out = split_digest(frame, most=most)
    assert {x.field: x.split_hash for x in out.collect()} == want
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    only = split_digest(frame.where("field = 'a'").drop("field"), [], most=most)
    assert [x.split_hash for x in only.collect()] == [want["a"]]
