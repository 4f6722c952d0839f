"""The jobs from the command line, with the package as an archive for the executors:

``spark-submit --py-files strata.zip strata/jobs.py JOB --input ... --output ...``

Streaming jobs process what has arrived and stop, so a scheduler can start them again;
``--seconds`` keeps them running with a trigger of that many seconds instead. A
micro-batch takes ``--files-per-batch`` files at most. Intermediate tables of a job are
removed when it ends.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.operators.quality import demand_gate  # noqa: E402
from strata.operators.search import top_documents  # noqa: E402
from strata.operators.views import city_progress  # noqa: E402
from strata.plans import (  # noqa: E402
    corpus, corridors, data_products, gameplay, governed_files, order_quality, orders_replica,
    purchases, retrieval, revenue, site_traffic, tips, warehouse, weather,
)
from strata.session import remove_scratch, tune  # noqa: E402
from strata.sources.external import jdbc_options, read_federated  # noqa: E402
from strata.sources.messages import read_messages  # noqa: E402
from strata.sources.sinks import overwrite  # noqa: E402
from strata.streaming import arrivals, bucketed, replica  # noqa: E402
from strata.streaming.tables import drain, every  # noqa: E402

Options = argparse.Namespace


def _stream(options: Options, writer: DataStreamWriter, label: str) -> None:
    checkpoint = f"{options.checkpoint}/{label}"
    if options.seconds:
        every(writer, checkpoint, options.seconds)
    else:
        drain(writer, checkpoint)


def _declared(spark: SparkSession, options: Options, declare: Callable) -> None:
    if options.declare:
        declare(spark, options.output)


def run_warehouse(spark: SparkSession, o: Options) -> DataFrame:
    house = warehouse.build_from_ndjson(spark, o.input, o.output, o.grain, warehouse.RAW_SCHEMA)
    return warehouse.verification(house)


def run_order_quality(spark: SparkSession, o: Options) -> DataFrame:
    return order_quality.summary(order_quality.run(spark, o.input, o.output, o.null_policy))


def run_load_csv(spark: SparkSession, o: Options) -> DataFrame:
    return tips.load(spark, o.input, o.output)


def run_enrich_csv(spark: SparkSession, o: Options) -> DataFrame:
    return tips.ratio_summary(tips.enrich_and_load(spark, o.input, o.output))


def run_rename_csv(spark: SparkSession, o: Options) -> DataFrame:
    return tips.summary(tips.rename_and_load(spark, o.input, o.output))


def run_site_traffic(spark: SparkSession, o: Options) -> DataFrame:
    return site_traffic.run(spark, o.input, o.output).conserved


def run_corpus(spark: SparkSession, o: Options) -> DataFrame:
    flow = corpus.run(spark.read.parquet(o.input))
    overwrite(flow.staged, f"{o.output}/stg_words")
    overwrite(flow.summary, f"{o.output}/corpus_summary")
    return flow.report


def run_data_product(spark: SparkSession, o: Options) -> DataFrame:
    columns, rules = {
        "orders": (data_products.ORDER_COLUMNS, data_products.ORDER_RULES),
        "customers": (data_products.CUSTOMER_COLUMNS, data_products.CUSTOMER_RULES),
    }[o.domain]
    loaded = data_products.load_domain(spark, o.input, columns, o.output)
    return data_products.scan_domain(loaded, rules)


def run_purchases(spark: SparkSession, o: Options) -> DataFrame:
    trained = purchases.run(spark.read.parquet(o.input))
    demand_gate(purchases.verify(trained))
    overwrite(trained.predictions, o.output)
    return trained.metrics()


def run_revenue(spark: SparkSession, o: Options) -> DataFrame:
    orders = read_federated(spark, jdbc_options(o.input, o.table), "region_code", "amount")
    return revenue.region_revenue(orders, spark.read.parquet(o.targets))


def run_retrieval(spark: SparkSession, o: Options) -> DataFrame:
    """Posts in, the most relevant documents embedded and written, questions answered."""
    posts = top_documents(spark.read.parquet(o.input), o.pattern, o.limit)
    overwrite(retrieval.document_embeddings(posts), o.output)
    documents = spark.read.parquet(o.output)
    found = retrieval.search(documents, retrieval.query_embeddings(spark.read.parquet(o.questions)))
    demand_gate(retrieval.verify(found))
    return found


def run_governed_files(spark: SparkSession, o: Options) -> DataFrame:
    """CSV files queried in place through the column policy; nothing is copied."""
    customers = governed_files.external_table(spark, o.table, o.input, o.schema)
    return governed_files.customers(customers, grants=o.grants.split(), mode=o.mode).open()


def run_open_table(spark: SparkSession, o: Options) -> DataFrame:
    named = tips.rename_and_load(spark, o.input, f"{o.output}/named")
    return tips.summary(tips.open_table(named, o.order.split(), "tip_id", f"{o.output}/open"))


def run_catalog(spark: SparkSession, o: Options) -> DataFrame:
    checked = data_products.check_catalog(spark.read.json(o.input))
    overwrite(checked, o.output)
    return checked.select("domain", "is_valid", "failed_rules")


def run_corridors(spark: SparkSession, o: Options) -> DataFrame:
    _declared(spark, o, corridors.declare)
    for label, writer in (("letters", corridors.dead_letter_writer), ("metrics", corridors.metrics_writer)):
        messages = read_messages(spark, o.input, files_per_batch=o.files_per_batch)
        _stream(o, writer(messages, o.output), label)
    return corridors.completeness(spark, o.output)


def run_gameplay(spark: SparkSession, o: Options) -> DataFrame:
    _declared(spark, o, gameplay.declare)
    profiles = lambda: spark.read.parquet(o.profiles)  # noqa: E731  read anew per micro-batch
    messages = read_messages(spark, o.input, files_per_batch=o.files_per_batch)
    _stream(o, gameplay.writer(messages, profiles, o.output), "events")
    return gameplay.verify(gameplay.enriched(spark, o.output), 1)


def run_weather(spark: SparkSession, o: Options) -> DataFrame:
    observed = weather.observations(spark, o.input, o.files_per_batch)
    _stream(o, weather.raw_table_writer(observed, o.output), "weather")
    return city_progress(weather.raw_table(spark, o.output))


def run_arrivals(spark: SparkSession, o: Options) -> DataFrame:
    writer = arrivals.load_newest_file(spark, o.input, o.schema, o.output, o.files_per_batch)
    _stream(o, writer, "arrivals")
    return spark.read.schema(o.schema).parquet(o.output)


def run_replica(spark: SparkSession, o: Options) -> DataFrame:
    _declared(spark, o, orders_replica.declare)
    if o.store:
        store = (bucketed.create(spark, spark.read.parquet(o.snapshot), orders_replica.KEYS, o.store, int(o.buckets))
                 if o.snapshot else bucketed.open_store(spark, o.store))
        store = orders_replica.run_stored(spark, store, o.input, o.output, f"{o.checkpoint}/changes", o.files_per_batch)
        return bucketed.rows(spark, store)
    snapshot = (replica.open_snapshot(spark, o.from_compacted) if o.from_compacted
                else replica.Snapshot(spark.read.parquet(o.snapshot)))
    checkpoint = f"{o.checkpoint}/changes"
    current = orders_replica.run(spark, snapshot, o.input, o.output, checkpoint, o.files_per_batch)
    if not o.compacted:
        return current
    return replica.compact(spark, snapshot, f"{o.output}/changes", orders_replica.KEYS, o.compacted).rows


BATCH = {
    "warehouse": (run_warehouse, {"--grain": "day"}),
    "order-quality": (run_order_quality, {"--null-policy": "fail"}),
    "load-csv": (run_load_csv, {}),
    "enrich-csv": (run_enrich_csv, {}),
    "rename-csv": (run_rename_csv, {}),
    "site-traffic": (run_site_traffic, {}),
    "corpus": (run_corpus, {}),
    "data-product": (run_data_product, {"--domain": "orders"}),
    "purchases": (run_purchases, {}),
    "revenue": (run_revenue, {"--table": "orders", "--targets": None}),
    "retrieval": (run_retrieval, {"--questions": None, "--pattern": None, "--limit": 100}),
    "governed-files": (run_governed_files, {
        "--table": None, "--schema": None, "--grants": "", "--mode": "deny"}),
    "open-table": (run_open_table, {"--order": "total_bill tip"}),
    "catalog": (run_catalog, {}),
}
STREAMS = {
    "corridors": (run_corridors, {}),
    "gameplay": (run_gameplay, {"--profiles": None}),
    "weather": (run_weather, {}),
    "arrivals": (run_arrivals, {"--schema": None}),
    "replica": (run_replica, {"--snapshot": "", "--from-compacted": "", "--compacted": "", "--store": "",
                              "--buckets": "256"}),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strata", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (run, extra) in (BATCH | STREAMS).items():
        job = jobs.add_parser(name)
        job.add_argument("--input", required=True)
        job.add_argument("--output", required=name not in ("revenue", "governed-files"))
        for flag, default in extra.items():
            kind = str if default is None else type(default)
            job.add_argument(flag, default=default, required=default is None, type=kind)
        if name in STREAMS:
            job.add_argument("--checkpoint", required=True)
            job.add_argument("--seconds", type=int, default=0)
            job.add_argument("--files-per-batch", type=int, default=1000)
            job.add_argument("--declare", action="store_true", help="create the target tables")
        job.set_defaults(run=run)
    return top


def main(argv: Sequence[str] | None = None) -> DataFrame:
    options = parser().parse_args(argv)
    spark = tune(SparkSession.builder.appName(f"strata-{options.job}").getOrCreate())
    result = options.run(spark, options)
    result.show(truncate=False)
    if getattr(options, "seconds", 0):
        spark.streams.awaitAnyTermination()
    return result


if __name__ == "__main__":
    main()
    remove_scratch(SparkSession.getActiveSession())
