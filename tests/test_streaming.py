import os
import tempfile

from quarry.streaming import land_stream


def test_stream_lands_new_files_once(spark, fresh_db):
    src = tempfile.mkdtemp()
    ck = tempfile.mkdtemp()
    t, log = f"{fresh_db['bronze']}.fx", f"{fresh_db['meta']}.ingestion_log"
    schema = "date_raw string, currency_raw string, mean_raw string, buy_raw string, sell_raw string"
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("r1,one,1,2,3\nr2,two,4,5,6\n")
    land_stream(spark, src, schema, "cbk_fx_csv", t, checkpoint=ck, log_table=log)
    assert spark.table(t).count() == 2
    # a replay of the same content in a new file adds nothing; a new row is added once
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("r1,one,1,2,3\nr3,three,7,8,9\n")
    land_stream(spark, src, schema, "cbk_fx_csv", t, checkpoint=ck, log_table=log)
    assert spark.table(t).count() == 3
    land_stream(spark, src, schema, "cbk_fx_csv", t, checkpoint=ck, log_table=log)
    assert spark.table(t).count() == 3


def test_stream_of_raw_lines_uses_the_ragged_parser(spark, fresh_db):
    from quarry.functions import fixed_values as fv
    from quarry.sources import parse_ragged_lines
    src, ck = tempfile.mkdtemp(), tempfile.mkdtemp()
    t, log = f"{fresh_db['bronze']}.fx", f"{fresh_db['meta']}.ingestion_log"
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write('r1,"one, two",1,2,3\n\nr2,b,c,d,e,,f\nr3,short\n')
    land_stream(spark, src, "value string", "cbk_fx_csv", t, fmt="text", checkpoint=ck, log_table=log,
                transform=lambda b: parse_ragged_lines(b, fv.FX_COLUMNS))
    rows = {r["date_raw"]: r for r in spark.table(t).collect()}
    assert len(rows) == 3
    assert rows["r1"]["currency_raw"] == "one, two"
    assert rows["r2"]["sell_raw"] == "e,,f"
    assert rows["r3"]["mean_raw"] is None


def test_a_replayed_batch_leaves_rows_and_log_unchanged(spark, fresh_db):
    """The stream dies after a batch was landed and logged, before its checkpoint knows: the batch comes again."""
    import shutil
    src, ck = tempfile.mkdtemp(), tempfile.mkdtemp()
    t, log = f"{fresh_db['bronze']}.fx", f"{fresh_db['meta']}.ingestion_log"
    schema = "date_raw string, currency_raw string, mean_raw string, buy_raw string, sell_raw string"
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("r1,one,1,2,3\nr2,two,4,5,6\n")
    land_stream(spark, src, schema, "cbk_fx_csv", t, checkpoint=ck, log_table=log)
    before = sorted(map(str, spark.table(log).collect())), spark.table(t).count()
    shutil.rmtree(os.path.join(ck, "commits"))
    land_stream(spark, src, schema, "cbk_fx_csv", t, checkpoint=ck, log_table=log)
    spark.catalog.refreshTable(log)
    assert (sorted(map(str, spark.table(log).collect())), spark.table(t).count()) == before
    assert len(before[0]) == 1 and "batch 0 of" in before[0][0]


def test_streamed_and_batch_files_are_read_alike(spark, fresh_db):
    """One reader for both: a quoted line break is one field either way."""
    from quarry.functions import fixed_values as fv
    from quarry.sources import read_ragged_csv
    src, ck = tempfile.mkdtemp(), tempfile.mkdtemp()
    t, log = f"{fresh_db['bronze']}.fx", f"{fresh_db['meta']}.ingestion_log"
    for name, text in (("a.csv", 'k1,"two\nlines",1,2,3\nk2,x,1,2,3\n'), ("b.csv", 'k3,"a""b",1,2,3,,4')):
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    land_stream(spark, src, "", "cbk_fx_csv", t, checkpoint=ck, log_table=log, max_files=1,
                read_files=lambda s, paths: read_ragged_csv(s, paths, fv.FX_COLUMNS))
    batch = read_ragged_csv(spark, src, fv.FX_COLUMNS)
    assert sorted(map(str, spark.table(t).select(*fv.FX_COLUMNS).collect())) == sorted(map(str, batch.collect()))
    assert spark.table(log).count() == 2        # one row for each batch of one file
