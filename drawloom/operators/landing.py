"""Landing of raw payloads: identity by content, shallow header, insert-only append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.functions.text import blank, content_hash, filled, part
from drawloom.sources.xml import SEGMENT


def append_unseen(batch: DataFrame, target: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows of batch whose key target lacks, one per key (the least by `order`, else by all columns); a re-run gives none."""
    if order:
        pick = Window.partitionBy(key).orderBy(order)
        batch = batch.withColumn("_n", F.row_number().over(pick)).where("_n = 1").drop("_n")
    else:
        batch = batch.dropDuplicates([key])
    return batch.join(target.select(key).distinct(), key, "left_anti")


def land(batch: DataFrame, path: str, key: str = "content_hash", partition: str | None = "ingest_date") -> DataFrame:
    """Append the unseen rows of batch to the Parquet table at path (made if it is missing); the summary of the run."""
    spark = batch.sparkSession
    try:
        target = spark.read.parquet(path).select(key)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        target = batch.select(key).limit(0)
    new = append_unseen(batch, target, key)
    writer = new.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return run_summary(batch, target, key)


def run_summary(batch: DataFrame, target_before: DataFrame, key: str) -> DataFrame:
    """One row: rows read, distinct keys inserted, rows skipped."""
    seen = batch.select(key).join(target_before.select(key).distinct().withColumn("_seen", F.lit(1)), key, "left")
    return seen.agg(F.count("*").alias("n_read"), F.countDistinct(F.when(F.col("_seen").isNull(), F.col(key))).alias("n_inserted")).withColumn("n_skipped", F.col("n_read") - F.col("n_inserted"))


def size_gated_text(content: Column, length: Column, gate: int) -> Column:
    """The payload as text where it is at most `gate` bytes long, else null."""
    return F.when(length <= gate, F.decode(content, "UTF-8"))


def stamp_ingestion(files: DataFrame, run_id: str, path: str = "path") -> DataFrame:
    now = F.current_timestamp()
    return files.withColumns({"bronze_id": F.expr("uuid()"), "ingest_run_id": F.lit(run_id), "ingested_at": now, "ingest_date": F.to_date(now), "source_filename": F.element_at(F.split(F.col(path), "/"), -1)})


def by_size(files: DataFrame, partitions: int, size: str = "length") -> DataFrame:
    """Dealt out by size, so that the few large payloads do not meet in one task."""
    return files.repartitionByRange(partitions, size)


def header_signals(nodes: DataFrame, budget: int = 6000, segment_budget: int | None = None, marker: str = "dexpi") -> DataFrame:
    """One row per content_hash: what the format, number and revision are told from.

    Where the application has the marker, elements up to `budget` count, as its
    history is in the title block; in other drawings all of them, as labels are
    anywhere. segment_budget: where to stop reading any drawing; None reads all.
    """
    n = nodes.where("error is null")
    if segment_budget is not None:
        n = n.where(F.col("ord") < segment_budget)
    first = lambda v, when: F.min(F.when(when & v.isNotNull(), F.struct("ord", v.alias("value"))))
    a = lambda name: F.col("attrs").getItem(name)
    info, drawing = F.col("tag") == "PlantInformation", F.col("tag") == "Drawing"
    segment = (F.col("tag") == SEGMENT) & ~F.col("in_catalogue")
    rows = F.filter(F.map_entries("ga"), lambda e: e["key"].rlike(r"^RevRow\d+(No|Date)$"))
    label = F.map_contains_key("ga", F.lit("Revision.RevisionNumber"))
    values = {
        "originating_system": first(a("OriginatingSystem"), info), "application": first(a("Application"), info),
        "drawing_number_attr": first(a("DrawingNumber"), drawing), "drawing_name": first(a("Name"), drawing), "drawing_revision_attr": first(a("Revision"), drawing),
        "operation_doc_no": first(F.col("ga").getItem("OperationCenterDocNo"), F.lit(True)),
    }
    out = n.groupBy("content_hash").agg(
        *[v.alias(k) for k, v in values.items()],
        F.array_sort(F.collect_list(F.when(F.size(rows) > 0, F.struct("ord", rows.alias("rows"))))).alias("rev_rows"),
        F.array_sort(F.collect_list(F.when(label, F.struct(F.col("ord"), F.col("ga").getItem("Revision.RevisionNumber").alias("number"), F.col("ga").getItem("Revision.TP_RevisionData").alias("date"))))).alias("labels"),
        F.coalesce(F.bool_or(segment), F.lit(False)).alias("segment_seen"), F.coalesce(F.bool_or(segment & ~blank(a("TagName"))), F.lit(False)).alias("segment_tagged"),
    )
    short = F.coalesce(F.contains(F.lower("application.value"), F.lit(marker.lower())), F.lit(False))
    counts = lambda x: ~F.col("_short") | (x["ord"] < budget)
    out = out.withColumn("_short", short).withColumns({
        **{k: F.when(counts(F.col(k)), F.col(k)["value"]) for k in values},
        "rev_rows": F.flatten(F.transform(F.filter("rev_rows", counts), lambda x: x["rows"])), "labels": F.filter("labels", counts),
    }).drop("_short")
    broken = nodes.where("error is not null").select("content_hash").distinct().withColumn("parsed", F.lit(False))
    good = out.withColumn("parsed", F.lit(True))
    return good.unionByName(broken, allowMissingColumns=True)


def detect_format(application: Column, marker: str, tagged: Column, seen: Column) -> Column:
    """DEXPI by the application's marker, else POSTPROC by a tagged segment, else DEXPI by any segment, else null."""
    return F.when(F.lower(application).contains(marker.lower()), "DEXPI").when(tagged, "POSTPROC").when(seen, "DEXPI")


def format_method(application: Column, marker: str, tagged: Column, seen: Column) -> Column:
    return F.when(F.lower(application).contains(marker.lower()), "APPLICATION").when(tagged, "SEGMENT_TAGNAME").when(seen, "SEGMENT_PRESENT").otherwise("UNKNOWN")


def latest_label(labels: Column, formats: tuple[str, ...] = ("yyyy/MM/dd", "yyyy-MM-dd", "ddMMMyy")) -> Column:
    """(number, date) of the label of the latest date; of equal dates the first label, of labels without a date the first one."""
    day = lambda d: F.coalesce(*[F.try_to_date(F.trim(d), f) for f in formats], F.lit("0001-01-01").cast("date"))
    best = F.array_max(F.transform(labels, lambda x: F.struct(day(x["date"]).alias("day"), (-x["ord"]).alias("before"), x["number"].alias("number"), x["date"].alias("date"))))
    return F.struct(best["number"].alias("number"), best["date"].alias("date"))


def highest_row(rows: Column) -> Column:
    """(number, date) of the highest RevRow that has a number; rows: entries RevRow{n}No and RevRow{n}Date."""
    n = lambda e: F.regexp_extract(e["key"], r"(\d+)", 1).cast("int")
    numbered = F.filter(rows, lambda e: e["key"].endswith("No") & ~blank(e["value"]))
    best = F.array_max(F.transform(numbered, lambda e: F.struct(n(e).alias("n"), e["value"].alias("number"))))
    dates = F.filter(rows, lambda e: e["key"].endswith("Date") & (n(e) == best["n"]))
    return F.struct(best["number"].alias("number"), F.try_element_at(dates, F.lit(1))["value"].alias("date"))


def headers(signals: DataFrame, marker: str = "dexpi", token: int = 0, override: str | None = None) -> DataFrame:
    """Format, document numbers, revision, project code and parse verdict of each payload."""
    args = (F.col("application"), marker, F.col("segment_tagged"), F.col("segment_seen"))
    s = signals.withColumn("source_format", detect_format(*args)).withColumn("format_detection_method", format_method(*args))
    post = F.col("source_format") == "POSTPROC"
    label, row = latest_label(F.col("labels")), highest_row(F.col("rev_rows"))
    s = s.withColumns({
        "document_number": F.when(post, F.coalesce(filled(F.col("drawing_name")), filled(F.col("drawing_number_attr")))).otherwise(F.coalesce(filled(F.col("operation_doc_no")), filled(F.col("drawing_number_attr")), filled(F.col("drawing_name")))),
        "client_document_number": F.when(post, F.coalesce(filled(F.col("drawing_name")), filled(F.col("drawing_number_attr")))).otherwise(F.coalesce(filled(F.col("drawing_number_attr")), filled(F.col("drawing_name")))),
        "drawing_revision": F.when(post, F.coalesce(label["number"], filled(F.col("drawing_revision_attr")))).otherwise(F.coalesce(row["number"], filled(F.col("drawing_revision_attr")), label["number"])),
        "drawing_revision_date": F.when(post, label["date"]).otherwise(F.coalesce(row["date"], label["date"])),
    })
    code = project_code(F.col("document_number"), token)
    return s.withColumns({
        "derived_project_code": code, "project_code": F.lit(override) if override else code,
        "project_code_source": F.when(F.lit(override is not None), "OVERRIDE").when(code.isNotNull(), "DOCUMENT_NUMBER"),
        "header_parse_ok": F.col("parsed") & F.col("document_number").isNotNull() & F.col("drawing_revision").isNotNull() & F.col("source_format").isNotNull(),
    }).select("content_hash", "originating_system", "source_format", "format_detection_method", "client_document_number", "document_number", "drawing_revision", "drawing_revision_date", "derived_project_code", "project_code", "project_code_source", F.coalesce("header_parse_ok", F.lit(False)).alias("header_parse_ok"))


def project_code(number: Column, token: int = 0, separator: str = "-") -> Column:
    """The token of a document number; null where it is missing or blank."""
    return part(number, separator, token)


def project_code_mismatches(rows: DataFrame) -> DataFrame:
    """One row: how many overridden codes differ from the derived ones."""
    return rows.agg(F.count_if((F.col("project_code_source") == "OVERRIDE") & (F.col("derived_project_code") != F.col("project_code"))).alias("n_mismatch"))


def bronze(files: DataFrame, nodes: DataFrame, run_id: str, gate: int = 20_000_000, **how) -> DataFrame:
    """The landing table of a batch of files: payload, stamps and header."""
    f = stamp_ingestion(files, run_id).withColumns({"content_hash": content_hash(F.col("content")), "content_text": size_gated_text(F.col("content"), F.col("length"), gate)})
    return f.join(headers(header_signals(nodes, marker=how.get("marker", "dexpi")), **how), "content_hash", "left")
