"""Run a layer job: ``python -m accrual <job> ...``.

select  topic -> topic       the documents an ingest run takes
silver  topic -> folder      documents to trials, sites and conditions
gold    folder               histories and features from the silver tables
check   folder               references between the tables that name nothing; fails if there are any
publish folder -> topics     the silver and gold tables as keyed records
load    topic -> folder      one continuous load, until stopped or drained
compact folder               fold a load's finished batches into a snapshot
train   folder area_map      fit, evaluate and promote the model
rank    folder plans ...     candidate sites of planned studies, ranked
export  folder out           dashboard lists as CSV
profile folder out           profiles of the gold tables as CSV; with a topic also of how it writes conditions
sample  topic -> folder      the report over a set of raw documents as CSV
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from accrual import schemas
from accrual.ml import ranking, training
from accrual.operators.areas import AREAS
from accrual.operators.joins import fk_violations
from accrual.operators.latest import latest_per_key
from accrual.plans import gold, reports, sample, silver
from accrual.session import build_session, durable
from accrual.sources.landing import select_documents
from accrual.sources.tables import export_csv, load_csv
from accrual.sources.topics import decode_json, read_topic, write_topic
from accrual.streaming import loads

# Table, and the key its records are published under.
PUBLISHED = {
    "trials": "nct_id",
    "trial_sites": "nct_id",
    "dim_mesh_conditions": "mesh_condition_id",
    "trial_features": "nct_id",
}

# Child, parent and the key by which one names the other.
REFERENCES = [
    ("trial_sites", "trials", ["nct_id"]),
    ("trial_features", "trials", ["nct_id"]),
    ("site_conditions_history", "site_history", ["country", "city", "zip"]),
]


def _arguments(given: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="accrual")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *positional: str, topic: str | None = None) -> argparse.ArgumentParser:
        added = jobs.add_parser(name)
        for argument in positional:
            added.add_argument(argument)
        if topic:
            added.add_argument("--topic", default=topic)
            added.add_argument("--servers", help="Kafka bootstrap servers")
            added.add_argument("--files", help="folder of topic files instead of Kafka")
            added.add_argument("--file-format", default="json")
        return added

    added = job("select", "out", topic="studies")
    added.add_argument("--run-date", required=True)
    added.add_argument("--daily", action="store_true")
    added.add_argument("--max-rows", type=int)
    job("silver", "folder", topic="studies")
    job("gold", "folder")
    job("check", "folder")
    job("publish", "folder", topic="accrual")
    added = job("load", "name", "folder", topic="")
    added.add_argument("--drain", action="store_true")
    added = job("compact", "name", "folder")
    added.add_argument("--trials", help="folder of the trials load, for sites")
    added = job("train", "folder", "area_map")
    added.add_argument("--rounds", type=int, default=training.MAX_ITER)
    job("rank", "folder", "area_map", "plans", "choices", "out")
    job("export", "folder", "out")
    job("profile", "folder", "out", topic="studies")
    job("sample", "out", topic="studies")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = _arguments(given)
    spark = build_session(f"accrual-{args.job}")

    def table(name):
        return spark.read.parquet(f"{args.folder}/{name}")

    def topic():
        return read_topic(spark, args.topic, args.servers, args.files, args.file_format)

    if args.job == "select":
        chosen = select_documents(topic(), args.run_date, args.daily, args.max_rows)
        chosen.write.mode("append").format(args.file_format).save(args.out)
    elif args.job == "silver":
        silver.write_silver(topic(), args.folder)
    elif args.job == "gold":
        gold.write_gold(table("trials"), table("trial_sites"), args.folder)
    elif args.job == "check":
        broken = 0
        for child, parent, keys in REFERENCES:
            found = fk_violations(table(child), table(parent), keys).persist()
            if number := found.count():
                print(f"{child}: {number} keys that {parent} lacks")
                found.show(truncate=False)
            broken += number
            found.unpersist()
        if broken:
            spark.stop()
            raise SystemExit(f"{broken} references name nothing")
    elif args.job == "publish":
        for name, key in PUBLISHED.items():
            files = args.files and f"{args.files}/{name}"
            write_topic(table(name), key, f"{args.topic}-{name}", args.servers, files, args.file_format)
    elif args.job == "load":
        source = {"files": args.files, "file_format": args.file_format}
        if args.servers:
            source = {"bootstrap_servers": args.servers}
        name = args.topic or args.name
        loads.start(spark, args.name, args.folder, args.drain, topic=name, **source).awaitTermination()
    elif args.job == "compact":
        parents = None
        if args.trials:
            parents = loads.current(spark, "trials", args.trials).select("nct_id", "version")
        print(loads.compact(spark, args.name, args.folder, parents))
    elif args.job == "train":
        area_map = load_csv(spark, args.area_map, schemas.AREA_MAP)
        trained = training.train(table("trial_features"), area_map, AREAS, max_iter=args.rounds)
        trained.metrics.show(truncate=False)
        trained.importances.show(truncate=False)
        print(training.save(trained, f"{args.folder}/model"))
    elif args.job == "rank":
        model, defaults = training.load(spark, f"{args.folder}/model")
        found = ranking.rank_sites(
            spark.read.schema(schemas.PLANS).json(args.plans),
            spark.read.schema("plan_id string, country string, city string").json(args.choices),
            table("site_history"),
            model,
            defaults,
            load_csv(spark, args.area_map, schemas.AREA_MAP),
        )
        for name, frame in found._asdict().items():
            export_csv(frame, f"{args.out}/{name}")
    elif args.job == "export":
        reports.write_dashboard(
            table("trial_features"),
            table("site_history"),
            table("site_conditions_history"),
            table("dim_mesh_conditions"),
            args.out,
        )
    elif args.job == "profile":
        found = reports.gold_report(table("trial_features"), table("site_history"))
        if args.files or args.servers:
            flat = silver.flatten_studies(decode_json(topic(), schemas.STUDY))
            newest = latest_per_key(flat, ["nct_id"], [F.col(c).desc() for c in silver.NEWEST_FIRST])
            documents = durable(newest.select("nct_id", "conditions", "meshes"))
            found |= reports.conditions_report(documents, table("trial_features"), table("dim_mesh_conditions"))
        for name, frame in found.items():
            export_csv(frame, f"{args.out}/{name}")
    elif args.job == "sample":
        metrics = durable(sample.study_metrics(decode_json(topic(), schemas.STUDY_PROFILE)))
        export_csv(sample.sample_report(metrics), f"{args.out}/sample")
    spark.stop()


if __name__ == "__main__":
    main()
