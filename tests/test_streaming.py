import os

from cellforge.operators import cells, relations, versions
from cellforge.session import shared_path
from cellforge.sources import fixtures as fx
from cellforge.sources.text import write_lines
from cellforge.streaming import compact_cell_log, read_cell_log, read_line_stream, start_cell_log, start_reject_counts
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_load_equals_batch_load(spark):
    src = shared_path(spark, "stream_src")
    lines = fx.line_input(spark, SF_SMALL, "user_lines")
    write_lines(lines.where("line < 'twitter_user\t5'"), os.path.join(src, "a"))
    write_lines(lines.where("line >= 'twitter_user\t5'"), os.path.join(src, "b"))
    stream = read_line_stream(spark, os.path.join(src, "*"), max_files_per_trigger=1)
    loaded = cells.table_cells(stream, fx.USER_NAMES, fx.USER_FAMILY, key_index=1, ts=fx.LOAD_TS)
    log = shared_path(spark, "cell_log")
    q = start_cell_log(loaded, log)
    q.awaitTermination(120)
    batch = cells.table_cells(lines, fx.USER_NAMES, fx.USER_FAMILY, key_index=1, ts=fx.LOAD_TS)
    assert rows(read_cell_log(spark, log)) == rows(versions.latest_cells(batch))
    table = compact_cell_log(spark, log, 4)
    assert rows(spark.table(table)) == rows(versions.latest_cells(batch))


def test_stream_reject_counts(spark):
    src = shared_path(spark, "stream_rejects")
    write_lines(fx.line_input(spark, SF_SMALL, "follow_lines"), src)
    stream = read_line_stream(spark, src)
    q = start_reject_counts(relations.follow_parsed(stream), relations.FOLLOW_REASONS, "follow_reject_totals")
    q.awaitTermination(120)
    streamed = {r.reason: r.n for r in spark.table("follow_reject_totals").collect()}
    batch = {r.reason: r.n for r in relations.follow_rejects(fx.line_input(spark, SF_SMALL, "follow_lines")).collect()}
    assert streamed == batch


def test_restart_from_checkpoint_loads_each_file_once(spark):
    src = shared_path(spark, "stream_restart_src")
    log = shared_path(spark, "stream_restart_log")
    ckpt = shared_path(spark, "stream_restart_ckpt")
    lines = fx.line_input(spark, SF_SMALL, "follow_lines")
    write_lines(lines.where("line < 'a_follows_b\t5'"), os.path.join(src, "a"))

    def run():
        stream = read_line_stream(spark, os.path.join(src, "*"))
        q = start_cell_log(relations.follow_cells(stream, ts=1), log, checkpoint=ckpt)
        q.awaitTermination(120)

    run()
    first = spark.read.parquet(log).count()
    run()  # nothing new: no duplicates
    assert spark.read.parquet(log).count() == first
    write_lines(lines.where("line >= 'a_follows_b\t5'"), os.path.join(src, "b"))
    run()  # only the new file is loaded
    batch = relations.follow_cells(lines, ts=1)
    assert rows(spark.read.parquet(log)) == rows(batch)


def test_streamed_log_as_deltas_of_a_snapshot(spark):
    from cellforge.operators import tables

    lines = fx.line_input(spark, SF_SMALL, "user_lines")
    first, rest = lines.where("line < 'twitter_user\t5'"), lines.where("line >= 'twitter_user\t5'")
    snapshot = tables.load_cell_table(cells.table_cells(first, fx.USER_NAMES, "base", key_index=1, ts=1), 4)
    src = shared_path(spark, "stream_delta_src")
    write_lines(rest, os.path.join(src, "a"))
    log = shared_path(spark, "stream_delta_log")
    stream = read_line_stream(spark, os.path.join(src, "*"))
    start_cell_log(cells.table_cells(stream, fx.USER_NAMES, "base", key_index=1, ts=2), log).awaitTermination(120)
    merged = tables.read_merged(spark, snapshot, [log], 4)
    whole = versions.upsert_cells(cells.table_cells(first, fx.USER_NAMES, "base", key_index=1, ts=1),
                                  cells.table_cells(rest, fx.USER_NAMES, "base", key_index=1, ts=2))
    assert rows(merged) == rows(whole)
