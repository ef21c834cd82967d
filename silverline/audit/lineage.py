"""Lineage events, log records and error records, one row each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the public event specification.
SPECIFICATION = "https://openlineage.io/spec/1-0-5/OpenLineage.json#/$defs"


@dataclass(frozen=True)
class Producer:
    """Who emits the events."""

    namespace: str = "bronze://silverline"
    name: str = "silverline://bronze/0.1.0"
    engine: str = "spark"


def _facet(producer: Producer, kind: str, **fields: Column) -> Column:
    """A facet as JSON text, so that all facets share one map type."""
    return F.to_json(
        F.struct(
            F.lit(producer.name).alias("_producer"),
            F.lit(f"{SPECIFICATION}/facets/{kind}").alias("_schemaURL"),
            *[value.alias(name) for name, value in fields.items()],
        )
    )


def _facets(**facets: Column) -> Column:
    parts = [part for name, value in facets.items() for part in (F.lit(name), value)]
    return F.create_map(*parts) if parts else F.from_json(F.lit("{}"), "map<string,string>")


def _dataset(name: Column, namespace: str, facets: Column) -> Column:
    return F.struct(F.lit(namespace).alias("namespace"), name.alias("name"), facets.alias("facets"))


def _none() -> Column:
    return F.array().cast("array<struct<namespace:string,name:string,facets:map<string,string>>>")


def _event(producer: Producer, kind: Column, job: Column, job_facets: Column, run_facets: Column, **sides: Column):
    return [
        kind.alias("eventType"),
        F.col("event_time").alias("eventTime"),
        F.lit(producer.name).alias("producer"),
        F.concat(F.lit(f"{SPECIFICATION}/"), kind, F.lit("Event")).alias("schemaURL"),
        F.struct(F.lit(producer.namespace).alias("namespace"), job.alias("name"), job_facets.alias("facets")).alias("job"),
        F.struct(F.col("run_id").alias("runId"), run_facets.alias("facets")).alias("run"),
        sides.get("inputs", _none()).alias("inputs"),
        sides.get("outputs", _none()).alias("outputs"),
    ]


def start_events(runs: DataFrame, producer: Producer = Producer()) -> DataFrame:
    """START events. Needs dataset, source_path, run_id, event_time."""
    about = F.concat(F.lit("Land the exports of "), "dataset", F.lit(" in bronze, each content once"))
    source = _facet(
        producer, "DatasourceDatasetFacet", name=F.lit("filesystem"), uri=F.concat(F.lit("file://"), "source_path")
    )
    return runs.select(
        *_event(
            producer,
            F.lit("START"),
            F.concat(F.lit("bronze.ingest."), "dataset"),
            _facets(documentation=_facet(producer, "DocumentationJobFacet", description=about)),
            _facets(nominalTime=_facet(producer, "NominalTimeRunFacet", nominalStartTime=F.col("event_time"))),
            inputs=F.array(_dataset(F.col("source_path"), "file://raw", _facets(dataSource=source))),
        )
    )


def finish_events(runs: DataFrame, producer: Producer = Producer()) -> DataFrame:
    """COMPLETE events, or FAIL events for runs with an error message.

    Needs dataset, output_path, run_id, event_time, row_count, byte_size, file_hash, duration_ms,
    error_message, error_stack.
    """
    failed = F.col("error_message").isNotNull()
    time = _facet(producer, "NominalTimeRunFacet", nominalEndTime=F.col("event_time"))
    engine = _facet(
        producer, "ProcessingEngineRunFacet", name=F.lit(producer.engine), processingTime=F.col("duration_ms")
    )
    error = _facet(
        producer, "ErrorMessageRunFacet", message=F.col("error_message"), stackTrace=F.col("error_stack")
    )
    storage = _facet(
        producer, "StorageDatasetFacet", storageLayer=F.lit("bronze"), fileFormat=F.lit("parquet"),
        contentHash=F.col("file_hash"),
    )
    source = _facet(
        producer, "DatasourceDatasetFacet", name=F.lit("bronze-layer"), uri=F.concat(F.lit("file://"), "output_path")
    )
    metrics = quality_facet(producer, F.col("row_count"), F.col("byte_size"), F.lit(True))
    outputs = F.array(
        _dataset(
            F.col("output_path"), producer.namespace,
            _facets(dataSource=source, storage=storage, dataQualityMetrics=metrics),
        )
    )
    return runs.select(
        *_event(
            producer,
            F.when(failed, "FAIL").otherwise("COMPLETE"),
            F.concat(F.lit("bronze.ingest."), "dataset"),
            _facets(),
            F.when(failed, _facets(nominalTime=time, errorMessage=error)).otherwise(
                _facets(nominalTime=time, processing=engine)
            ),
            outputs=F.when(failed, _none()).otherwise(outputs),
        )
    )


def quality_facet(producer: Producer, rows: Column, size: Column, success: Column) -> Column:
    return _facet(producer, "DataQualityMetricsInputDatasetFacet", rowCount=rows, bytes=size, success=success)


def sql_facet(query: str, producer: Producer = Producer()) -> Column:
    """The SQL of a transform, as a job facet."""
    return _facet(producer, "SQLJobFacet", query=F.lit(query))


def transform_events(runs: DataFrame, query: str, producer: Producer = Producer()) -> DataFrame:
    """COMPLETE events of a SQL transform. Needs dataset, run_id, event_time."""
    return runs.select(
        *_event(
            producer, F.lit("COMPLETE"), F.concat(F.lit("silver.transform."), "dataset"),
            _facets(sql=sql_facet(query, producer)), _facets(),
        )
    )


def validation_events(
    results: DataFrame, runs: DataFrame, producer: Producer = Producer()
) -> DataFrame:
    """One event per validated dataset, with its assertions.

    `results` are expectation rows (a few per dataset); `runs` has dataset, bronze_path, run_id,
    event_time, row_count, byte_size.
    """
    assertions = results.groupBy("dataset").agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("expectation_type").alias("assertion"), "column", "success"))
        ).alias("_assertions"),
        F.every("success").alias("_success"),
    )
    rows = runs.join(assertions, "dataset")
    about = F.concat(F.lit("Check the bronze rows of "), "dataset")
    checks = _facet(producer, "DataQualityAssertionsRunFacet", assertions=F.col("_assertions"))
    metrics = quality_facet(producer, F.col("row_count"), F.col("byte_size"), F.col("_success"))
    return rows.select(
        *_event(
            producer,
            F.lit("COMPLETE"),
            F.concat(F.lit("bronze.validate."), "dataset"),
            _facets(documentation=_facet(producer, "DocumentationJobFacet", description=about)),
            _facets(dataQuality=checks),
            inputs=F.array(_dataset(F.col("bronze_path"), producer.namespace, _facets(dataQualityMetrics=metrics))),
        )
    )


def log_records(df: DataFrame, severity: Column, body: Column, attributes: Column) -> DataFrame:
    """Structured log rows; the span id is derived from the record itself."""
    span = F.substring(F.sha2(F.concat_ws("|", "event_time", severity, body, F.to_json(attributes)), 256), 1, 16)
    return df.select(
        F.col("event_time").alias("timestamp"),
        severity.alias("severity"),
        body.alias("body"),
        attributes.alias("attributes"),
        F.col("run_id").alias("traceId"),
        span.alias("spanId"),
        F.substring("event_time", 1, 10).alias("date"),
    )


def error_records(df: DataFrame) -> DataFrame:
    """Error rows with defaults. Needs name, message, stack, stage, selector, event_time."""
    return df.select(
        F.coalesce("name", F.lit("Error")).alias("name"),
        F.coalesce("message", F.lit("")).alias("message"),
        F.coalesce("stack", F.lit("")).alias("stack"),
        F.coalesce("stage", F.lit("unknown")).alias("stage"),
        F.lit(None).cast("string").alias("url"),
        F.col("selector"),
        F.col("event_time").alias("timestamp"),
    )
