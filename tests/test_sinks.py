import csv

from factorlab.session import cut_lineage, release, staged
from factorlab.sources import sinks


def test_factor_text_json_and_views(spark, tmp_path):
    f = spark.createDataFrame([(1, [0.5, 0.25]), (2, [1.0, 2.0])], "reviewer_index int, features array<double>")
    sinks.write_factors(f, str(tmp_path / "X"), fmt="text")
    lines = sorted(r[0] for r in spark.read.text(str(tmp_path / "X")).collect())
    assert lines == ["(1, [0.5,0.25])", "(2, [1.0,2.0])"]
    sinks.write_json(f, str(tmp_path / "J"))
    back = spark.read.json(str(tmp_path / "J")).orderBy("reviewer_index").collect()
    assert [list(r["features"]) for r in back] == [[0.5, 0.25], [1.0, 2.0]]
    sinks.register_views({"user_factors": f})
    assert spark.sql("SELECT count(*) FROM user_factors").first()[0] == 2


def test_sorted_csv_is_ordered_over_all_files(spark, tmp_path):
    df = spark.range(0, 500).selectExpr("(id * 37) % 500 AS k", "id AS v").repartition(5)
    sinks.write_sorted_csv(df, str(tmp_path / "S"), "k")
    rows = []
    for part in sorted((tmp_path / "S").glob("part-*.csv")):
        with open(part) as f:
            rows += [int(r["k"]) for r in csv.DictReader(f)]
    assert rows == list(range(500))


def test_cut_lineage_leaves_the_callers_cache(spark):
    df = spark.range(50).selectExpr("id * 2 AS x").persist()
    assert cut_lineage(df).count() == 50
    assert df.is_cached and df.storageLevel.useMemory
    df.unpersist()


def test_staged_table_and_release(spark):
    from pathlib import Path

    table, path = staged(spark.range(5).toDF("x"), "t")
    assert table.count() == 5
    release(spark, path)
    assert not Path(path.removeprefix("file:")).exists()


def test_quarantine_write_is_not_sorted_and_keeps_the_setting(spark):
    from factorlab.sources.quarantine import split_rejects

    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    rows = spark.range(1000).selectExpr("id", "if(id % 7 = 0, 'seven', null) reason").repartition(3)
    checked = split_rejects(rows)
    assert (checked.n_accepted, checked.n_rejected) == (857, 143)
    assert checked.accepted.count() == 857 and {r.reason for r in checked.rejected.collect()} == {"seven"}
    assert spark.conf.get(key, None) == before


def test_lines_written_fast_read_back(spark, tmp_path):
    from factorlab.sources.examples import write_lines

    lines = spark.range(20_000).selectExpr("concat('([', cast(rand(3) as string), '], [', cast(rand(4) as string), '], 1.0)') value")
    fast, slow = str(tmp_path / "fast"), str(tmp_path / "slow")
    write_lines(lines, fast)
    lines.write.text(slow, compression="gzip")
    assert sorted(r[0] for r in spark.read.text(fast).collect()) == sorted(r[0] for r in spark.read.text(slow).collect())
    size = lambda p: sum(f.stat().st_size for f in (tmp_path / p).glob("*.gz"))
    assert size("slow") != size("fast") < 1.1 * size("slow")
