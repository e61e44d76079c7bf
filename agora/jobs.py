"""Command-line entry points for the daily jobs and the stream.

    python -m agora.jobs ingest-posts    --communities subs.csv --snapshots listing/ --out posts/
    python -m agora.jobs ingest-comments --comments comments/ --posts posts/ --communities subs.csv --out comments_out/
    python -m agora.jobs stage-users     --comments comments_out/ --out stg/ --run-date 2024-01-08
    python -m agora.jobs report          consecutive_days --staging stg/ --out report/ [--year 2024 --week 2]
    python -m agora.jobs flag-stream     --source kafka --option kafka.bootstrap.servers=... --option subscribe=events \\
                                         --posts posts/ --community-flags flags/ --sink kafka --option topic=flagged \\
                                         --checkpoint ckpt/

Each command is one Spark application; the session comes from
``spark-submit`` (its settings win) and only the settings a job relies on
(UTC, AQE) are applied on top.  ``--run-date`` defaults to today (UTC).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from agora.functions.dates import as_date
from agora.operators.calendar import week_masks_of_days
from agora.plans import ingest, reports_sql, staging, weekly
from agora.session import configure
from agora.sinks.batch import write_partitioned
from agora.sources import files
from agora.streaming import content_flag


def _session(app: str) -> SparkSession:
    return configure(SparkSession.builder.appName(app).getOrCreate())


def _options(pairs: list[str] | None) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _today() -> str:
    return dt.datetime.now(dt.timezone.utc).date().isoformat()


def _quarantine(bad: DataFrame, rejected: DataFrame, a: argparse.Namespace) -> None:
    """The run's own folders: a run that is repeated replaces them."""
    for name, rows in (("corrupt", bad), ("rejected", rejected)):
        rows.write.mode("overwrite").json(f"{a.quarantine}/{name}/run={a.run_date}")


def cmd_ingest_posts(a: argparse.Namespace) -> None:
    spark = _session("agora-ingest-posts")
    raw = files.read_post_snapshots(spark, a.snapshots, a.format)
    # The run day first: both outputs then read only that day's listing folders.
    day = raw.where(F.col("snapshot_date") == F.lit(dt.date.fromisoformat(a.run_date)))
    snaps, bad = files.split_corrupt(day)
    communities = files.read_communities_csv(spark, a.communities)
    posts, rejected = ingest.ingest_posts(
        snaps, communities, a.run_date, a.top_n, a.per_community,
        with_rejected=True, names=ingest.top_names(communities, a.top_n),
    )
    seen = Observation("posts")
    write_partitioned(posts.observe(seen, F.count(F.lit(1)).alias("accepted")), a.out, mode=a.mode)
    print(f"ingest-posts {a.run_date}: {seen.get['accepted']} posts accepted", file=sys.stderr)
    if a.quarantine:
        _quarantine(bad, rejected, a)


def cmd_ingest_comments(a: argparse.Namespace) -> None:
    spark = _session("agora-ingest-comments")
    # ``--comments`` names the landed folder of the run; the day window is pushed to the scan.
    snaps, bad = files.split_corrupt(files.read_comment_snapshots(spark, a.comments, a.format))
    communities = files.read_communities_csv(spark, a.communities)
    comments, rejected = ingest.ingest_comments(
        snaps, files.read_stored(spark, a.posts), communities, a.run_date, a.top_n,
        with_rejected=True, names=ingest.top_names(communities, a.top_n),
    )
    seen = Observation("comments")
    write_partitioned(comments.observe(seen, F.count(F.lit(1)).alias("accepted")), a.out, mode=a.mode)
    print(f"ingest-comments {a.run_date}: {seen.get['accepted']} comments accepted", file=sys.stderr)
    if a.quarantine:
        _quarantine(bad, rejected, a)


def cmd_stage_users(a: argparse.Namespace) -> None:
    spark = _session("agora-stage-users")
    comments = spark.read.parquet(a.comments)
    first, end = as_date(a.run_date), as_date(a.end_date) if a.end_date else as_date(a.run_date) + dt.timedelta(days=1)
    if "etl_date" in comments.columns:  # the comment's day: only the folders of the run are read
        comments = comments.where((F.col("etl_date") >= F.lit(first)) & (F.col("etl_date") < F.lit(end)))
    staged = staging.stage_users(comments, first, end, user_col=a.user_col, day_col=a.day_col)
    if a.jdbc_profile:
        opts = files.connection_options(spark, a.jdbc_profile)
        props = {k: v for k, v in opts.items() if k != "url"}
        staging.write_staging_jdbc(staged, opts["url"], a.table, props)
    elif a.buckets:
        staging.write_staging_table(staged, a.table, a.buckets, path=a.out)
    else:
        staging.publish_staging(staged, a.out, first, end)


def cmd_report(a: argparse.Namespace) -> None:
    spark = _session(f"agora-report-{a.name}")
    stg = spark.table(a.staging_table) if a.staging_table else staging.read_staging(spark, a.staging)
    if a.name == "all" or a.prune:
        # one mask table for the reports; only the week's day folders are read
        masks = week_masks_of_days(stg, a.year, a.week, every_year=not a.prune)
        weekly.write_all_reports(stg, a.out, a.year, a.week, masks=masks, names=None if a.name == "all" else [a.name])
        return
    out = reports_sql.run_report(spark, a.name, stg, a.year, a.week)
    out.write.mode("overwrite").parquet(a.out)


def cmd_flag_stream(a: argparse.Namespace) -> None:
    spark = _session("agora-flag-stream")
    opts = _options(a.option)
    source_opts = {k: v for k, v in opts.items() if k != "topic"}
    parsed = content_flag.parse_events(
        content_flag.read_event_values(spark, a.source, a.input, source_opts, a.max_files_per_trigger)
    )
    events = content_flag.good_events(parsed)
    quarantine = None
    if a.quarantine:
        # Records that do not parse go to their own append-only JSON output.
        quarantine = content_flag.bad_events(parsed).writeStream.format("json").option(
            "path", f"{a.quarantine}/data"
        ).option("checkpointLocation", f"{a.quarantine}/checkpoint")
        quarantine = (quarantine.trigger(availableNow=True) if a.available_now else quarantine).start()
    if a.dedupe:
        events = content_flag.dedupe_events(events, a.dedupe)
    sink_opts = {k: v for k, v in opts.items() if k == "topic" or k.startswith("kafka.")}
    query = content_flag.start_current_flags(
        events, content_flag.stored_lookups(a.posts, a.community_flags), a.sink, a.checkpoint, path=a.output,
        options=sink_opts, available_now=a.available_now, processing_time=None if a.available_now else a.trigger,
    )
    watched = [q for q in (query, quarantine) if q is not None]
    try:
        content_flag.await_all(watched)
    finally:
        for q in watched:
            if q.isActive:
                q.stop()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="agora.jobs", description="Daily community-activity jobs and the content-flag stream.")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("ingest-posts", help="posts of the run day for the top-N communities, from listing snapshots")
    s.add_argument("--communities", required=True)
    s.add_argument("--snapshots", required=True)
    s.add_argument("--format", default="json", choices=["json", "parquet"])
    s.add_argument("--out", required=True)
    s.add_argument("--run-date", default=_today())
    s.add_argument("--top-n", type=int, default=ingest.TOP_COMMUNITIES)
    s.add_argument("--per-community", type=int, default=ingest.HOT_POSTS_PER_COMMUNITY)
    s.add_argument("--mode", default="overwrite", choices=["append", "overwrite"])
    s.add_argument("--quarantine")
    s.set_defaults(fn=cmd_ingest_posts)

    s = sub.add_parser("ingest-comments", help="comments of the run day under the stored posts of the top-N communities")
    s.add_argument("--comments", required=True)
    s.add_argument("--format", default="json", choices=["json", "parquet"])
    s.add_argument("--posts", required=True)
    s.add_argument("--communities", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--run-date", default=_today())
    s.add_argument("--top-n", type=int, default=ingest.TOP_COMMUNITIES)
    s.add_argument("--mode", default="overwrite", choices=["append", "overwrite"])
    s.add_argument("--quarantine")
    s.set_defaults(fn=cmd_ingest_comments)

    s = sub.add_parser("stage-users", help="(author, day) rows of the run day into the staging table")
    s.add_argument("--comments", required=True)
    s.add_argument("--out")
    s.add_argument("--run-date", default=_today())
    s.add_argument("--end-date")
    s.add_argument("--user-col", default="author_name", help="the column that holds the user")
    s.add_argument("--day-col", default="etl_ts", choices=["etl_ts", "created_utc"])
    s.add_argument("--jdbc-profile")
    s.add_argument("--table", default="dim_all_users_stg")
    s.add_argument("--buckets", type=int, help="write a catalog table bucketed by author (distinct author/day rows)")
    s.set_defaults(fn=cmd_stage_users)

    s = sub.add_parser("report", help="weekly activity reports from the staging table")
    s.add_argument("name", choices=[*sorted(reports_sql.REPORTS), "all"])
    s.add_argument("--staging", help="folder that stage-users published to")
    s.add_argument("--staging-table", help="catalog table instead (bucketed: no exchange)")
    s.add_argument("--prune", action="store_true", help="the week of that year only (default: that week number of any year); writes OUT/<name>")
    s.add_argument("--out", required=True)
    s.add_argument("--year", type=int, default=2024)
    s.add_argument("--week", type=int, default=2)
    s.set_defaults(fn=cmd_report)

    s = sub.add_parser("flag-stream", help="flag adult posts in non-adult communities on a stream")
    s.add_argument("--source", default="kafka", choices=["kafka", "json"])
    s.add_argument("--input")
    s.add_argument("--option", action="append", help="key=value, source/sink option")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--dedupe", help="watermark delay, e.g. '1 hour'")
    s.add_argument("--posts", required=True, help="stored posts (post_id, over_18)")
    s.add_argument("--community-flags", required=True, help="subreddit, community_adult")
    s.add_argument("--sink", default="kafka", choices=["kafka", "json", "parquet"])
    s.add_argument("--output")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--quarantine", help="folder for records that do not parse (own checkpoint inside)")
    s.add_argument("--trigger", default="10 seconds")
    s.add_argument("--available-now", action="store_true")
    s.set_defaults(fn=cmd_flag_stream)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main(sys.argv[1:])


__all__ = ["main", "parser"]
