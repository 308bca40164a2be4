"""Late files add to their snapshot what one delivery of all files would have held."""

from test_jobs import D, LOOSE, alerts, day_lines, player, run, write_raw

from snapgate.plans import jobs
from snapgate.sources.raw import read_layer
from snapgate.streaming.late import add_files, add_late_files

FIRST = [*day_lines(D[0]), player(3, D[0], points=99)]
SECOND = [player(3, D[0], points=77), player(4, D[0], "T9"), player(50, D[0], points=1), player(50, D[0], points=2), f",P,T,S,1,1,1,{D[0]}"]


def silver(spark, root):
    return sorted((r["snapshot_date"], r["player_id"], r["team"], r["points"]) for r in read_layer(spark, f"{root}/silver").collect())


def test_two_deliveries_give_the_rows_of_one(spark, tmp_path):
    whole, root, check = (str(tmp_path / n) for n in ("whole", "late", "check"))
    for path in (whole, root):
        write_raw(path, D[0], FIRST, "a")
    write_raw(whole, D[0], SECOND, "b")
    write_raw(whole, D[1], day_lines(D[1]))
    jobs.ingest(spark, LOOSE, run(whole), D[:2])
    jobs.validate_and_clean(spark, LOOSE, run(whole), D[:2])
    add_late_files(spark, LOOSE, root, check, "2024-02-01 00:00:00")
    before = silver(spark, root)
    write_raw(root, D[0], SECOND, "b")
    write_raw(root, D[1], day_lines(D[1]))
    add_late_files(spark, LOOSE, root, check, "2024-02-02 00:00:00")
    assert silver(spark, root) == silver(spark, whole) and set(before) < set(silver(spark, root))
    # nothing new, and the same files again by a stream that has forgotten them
    for again in (check, str(tmp_path / "other")):
        add_late_files(spark, LOOSE, root, again, "2024-02-03 00:00:00")
        assert silver(spark, root) == silver(spark, whole)
    assert read_layer(spark, f"{root}/bronze").count() == read_layer(spark, f"{whole}/bronze").count()
    jobs.enforce_schema(spark, LOOSE, run(root), D[:2])
    jobs.load_gold(spark, LOOSE, run(root), D[:2], "v1")
    assert spark.read.parquet(f"{root}/gold").count() == len({(r[0], r[1]) for r in silver(spark, whole)})


def test_a_batch_that_died_behind_bronze_is_completed(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_raw(root, D[0], FIRST, "a")
    files = [(f"{root}/raw/snapshot_date={D[0]}/a.csv", D[0])]
    add_files(spark, LOOSE, root, files, "2024-02-01 00:00:00")
    want, bronze = silver(spark, root), read_layer(spark, f"{root}/bronze").count()
    spark.read.parquet(f"{root}/silver").limit(0).drop("snapshot_date").write.mode("overwrite").parquet(f"{root}/silver/snapshot_date={D[0]}")
    add_files(spark, LOOSE, root, files, "2024-02-01 00:00:00")
    assert silver(spark, root) == want and read_layer(spark, f"{root}/bronze").count() == bronze


def test_files_beyond_the_time_limit_are_told_and_left(spark, tmp_path):
    root, check = str(tmp_path / "r"), str(tmp_path / "check")
    write_raw(root, "2024-03-01", day_lines("2024-03-01"))
    write_raw(root, "2024-02-20", day_lines("2024-02-20"))
    write_raw(root, "2024-02-28", day_lines("2024-02-28"))
    add_late_files(spark, LOOSE, root, check, "2024-03-01 00:00:00", within_days=3)
    assert {r[0] for r in silver(spark, root)} == {"2024-02-28", "2024-03-01"}
    assert alerts(spark, root) == [("WARN", "INGESTION", "2024-02-20", "File came too late for its snapshot and was not read")]
