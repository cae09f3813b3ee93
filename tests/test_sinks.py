"""The table store's commits, and updates and deletes in a database."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from marlstone.sources import database
from marlstone.sources.store import Conflict, TableStore
from marlstone.sources.workspace import Workspace, hadoop_path


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_versions(spark):
    store = TableStore(spark, Workspace(spark, "t").path("a"))
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.version() is None and store.commit(spark.range(3), dry_run=True) is None
    assert [store.commit(spark.range(n), sort="id") for n in (3, 5)] == [0, 1]
    assert store.count() == store.estimated_count() == 5 and store.read(version=0).count() == 3


def test_a_failed_write_is_in_nobodys_way(spark):
    store = TableStore(spark, Workspace(spark, "t").path("b"))
    store.commit(spark.range(3))
    with pytest.raises(Exception, match="no such luck"):
        store.commit(spark.range(9).withColumn("x", F.raise_error(F.lit("no such luck")).cast("int")))
    assert store.version() == 0 and store.commit(spark.range(4)) == 1 and store.count() == 4


def test_a_crash_between_data_and_commit(spark):
    """A commit file without its content, as a writer leaves it that dies there: the version before stays current, and the next commit goes on."""
    store = TableStore(spark, Workspace(spark, "t").path("c"))
    store.commit(spark.range(3))
    path, fs = hadoop_path(spark, store._place(1))
    fs.create(path, False).close()
    assert store.version() == 0 and store.count() == 3
    assert store.commit(spark.range(7)) == 2 and store.count() == 7
    assert store.vacuum(keep=1) and store.count() == 7


def test_two_writers(spark):
    root = Workspace(spark, "t").path("d")
    one, other = TableStore(spark, root), TableStore(spark, root)
    one.commit(spark.range(1))
    other._commits = lambda: []  # it listed the folder before the first one's commit
    with pytest.raises(Conflict):
        other.commit(spark.range(2))
    assert one.version() == 0 and one.count() == 1


@pytest.fixture
def base(tmp_path):
    path = str(tmp_path / "base.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE works (id INTEGER PRIMARY KEY, type TEXT CHECK (type IN ('movie', 'series')), season INTEGER)")
        c.executemany("INSERT INTO works VALUES (?, ?, ?)", [(i, "movie", 1) for i in range(20)])
    return path


def connector(path):
    def connect():
        import sqlite3

        return sqlite3.connect(path, timeout=30)

    return connect


PATCH = "id long, changed array<string>, type string, season int"


def test_sparse_updates(spark, base):
    patch = [(0, ["type"], "series", 9), (1, ["season"], "series", None), (2, [], "series", 9), (3, None, "series", 9), (99, ["type"], "series", 1), (4, ["type", "season"], "series", 2)]
    done = database.update_rows(spark.createDataFrame(patch, PATCH).coalesce(1), connector(base), "works", ["type", "season"]).collect()
    assert sum(r.done for r in done) == len(patch) and not any(r.error for r in done)
    with sqlite3.connect(base) as c:
        assert c.execute("SELECT * FROM works WHERE id < 5").fetchall() == [(0, "series", 1), (1, "movie", None), (2, "movie", 1), (3, "movie", 1), (4, "series", 2)]


def test_a_bad_row_keeps_no_other_out(spark, base):
    patch = [(i, ["type"], "song" if i == 7 else "series", None) for i in range(10)]
    done = database.update_rows(spark.createDataFrame(patch, PATCH).coalesce(1), connector(base), "works", ["type"], batch=4).collect()
    assert [(r.id, "CHECK" in r.error) for r in done if r.error] == [("7", True)] and sum(r.done for r in done) == 9
    with sqlite3.connect(base) as c:
        assert c.execute("SELECT count(*) FROM works WHERE type = 'series'").fetchone() == (9,)
    with pytest.raises(ValueError, match="not a name"):
        database.update_rows(spark.createDataFrame(patch, PATCH), connector(base), "works; DROP TABLE works", ["type"])


def test_deletes(spark, base):
    doomed = spark.createDataFrame([(1,), (1,), (5,), (77,), (None,)], "id long").coalesce(1)
    assert sum(r.done for r in database.delete_ids(doomed, connector(base), "works").collect()) == 3
    with sqlite3.connect(base) as c:
        assert c.execute("SELECT count(*) FROM works").fetchone() == (18,)


def test_kinds_of_errors():
    assert database.is_transient(TimeoutError("x")) and database.is_transient(sqlite3.OperationalError("database is locked"))
    assert database.is_data_error(sqlite3.IntegrityError("CHECK constraint failed")) and not database.is_transient(sqlite3.IntegrityError("CHECK constraint failed: reset"))
    error = RuntimeError("?")
    error.sqlstate = "40001"
    assert database.is_transient(error)
    error.sqlstate = "22001"
    assert database.is_data_error(error) and not database.is_transient(error)


def test_transient_errors_are_tried_again():
    opened, failures = [], [sqlite3.OperationalError("connection reset"), None]

    class Connection:
        def cursor(self):
            return self

        def commit(self): ...
        def rollback(self): ...
        def close(self): ...

    def work(cursor):
        if error := failures.pop(0):
            raise error

    def connect():
        opened.append(1)
        return Connection()

    session = database._Session(connect, tries=2)
    session.run(work)
    assert len(opened) == 2


def test_freshness_follows_the_source_alone(spark):
    from marlstone.operators import patch

    then, now = "2024-01-01 00:00:00", "2024-02-02 00:00:00"
    kinds = "id long, seeders long, title string, updated_at string"
    before = spark.createDataFrame([(1, 5, "a", then), (2, 5, "b", then), (3, None, "c", then), (9, 1, "gone", then)], kinds)
    after = spark.createDataFrame([(1, 5, "A", now), (2, 6, "b", now), (3, None, "C", now), (4, 1, "new", None)], kinds)
    assert {r.id: r.updated_at for r in patch.refreshed(before, after, "id", ["seeders"], now).collect()} == {1: then, 2: now, 3: then, 4: now}


def test_doctor(spark, capsys, monkeypatch, tmp_path):
    from marlstone.__main__ import main
    from marlstone.config import Config
    from marlstone.plans.doctor import examine, masked
    from marlstone.sources.catalogues import Catalogues

    store = TableStore(spark, Workspace(spark, "t").path("doctor"))
    names = lambda found: {f.name: f.ok for f in found}
    assert names(examine(Config(), store)) == {"settings": True, "table": False, "telemetry": False}
    store.commit(spark.range(2).selectExpr("id", "'t' title", "1L seeders", "timestamp'2024-01-01' updated_at"))
    assert names(examine(Config(steps=("adult", "dead")), store)) == {"settings": True, "table": True}
    lacking = examine(Config(steps=("size",)), store)
    assert not lacking[1].ok and "size lacks size_bytes, type" in lacking[1].detail
    refused = examine(Config(), None, Catalogues(tmdb_key="k" * 32, ask=lambda url, **_: 1 / 0))
    assert names(refused)["TMDB key"] is False and "k" * 10 not in str(refused[-1]) and masked("short") == "set (5 characters)"
    monkeypatch.chdir(tmp_path)
    (tmp_path / ".env").write_text("STEPS=adult\nexport OTHER='x'\n")
    assert main(["doctor"]) == 0 and "steps adult" in capsys.readouterr().out
    (tmp_path / ".env").write_text("STEPS=nonsense")
    assert main(["doctor"]) == 1 and main(["parse", "Glass.Harbour.S01E02.mkv"]) == 0 and main([]) == 2


def test_summary_and_samples(spark, tmp_path, caplog):
    import logging

    from marlstone.plans import pipeline

    result = pipeline.RunResult([pipeline.StepResult("adult", 1.0, None, {"deleted": 2})], spark.range(1))
    path = tmp_path / "summary.md"
    assert result.write_summary(str(path)) and result.write_summary(str(path)) and path.read_text().count("deleted 2") == 2
    with caplog.at_level(logging.INFO, logger=pipeline.__name__):
        pipeline._say("adult", spark.range(9).selectExpr("id", "concat('t', id) title"), pipeline.Config(log_samples=3))
    assert [r.getMessage() for r in caplog.records] == [f"adult deletes {i}: t{i}" for i in range(3)]
