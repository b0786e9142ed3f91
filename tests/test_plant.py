"""Drawings end to end: made-up sheets in two revisions, every id minted anew."""

import itertools

from pyspark.sql import functions as F

from drawloom.operators import landing
from drawloom.plans import plant
from drawloom.sources import files, xml
from drawloom.tables import cut

_ids = itertools.count(1)


def generic(**values):
    return "<GenericAttributes>" + "".join(f'<GenericAttribute Name="{k}" Value="{v}"/>' for k, v in values.items()) + "</GenericAttributes>"


def gear(tag, nozzles):
    return f'<Equipment ID="E{next(_ids)}">{generic(ItemTag=tag)}' + "".join(f'<Nozzle ID="N{next(_ids)}"/>' for _ in range(nozzles)) + "</Equipment>"


def line(tag, size, *classes):
    parts = "".join(f'<PipingComponent ID="P{next(_ids)}" ComponentClass="{c}"><Position><Location X="{10 * i}" Y="0"/></Position></PipingComponent>' for i, c in enumerate(classes))
    return f'<PipingNetworkSegment ID="S{next(_ids)}" TagName="{tag}">{generic(OperFluidCode="AB", ItemTag=tag, NominalDiameter=size)}<CenterLine><Coordinate X="0" Y="0"/><Coordinate X="100" Y="0"/></CenterLine>{parts}</PipingNetworkSegment>'


def sheet(name, revision, date, *body):
    label = generic(**{"Revision.RevisionNumber": revision, "Revision.TP_RevisionData": date})
    return f'<?xml version="1.0" encoding="UTF-8"?><PlantModel><PlantInformation OriginatingSystem="X"/><Drawing Name="{name}" Revision="{revision}"/><Label>{label}</Label><PipingNetworkSystem ID="Y{next(_ids)}">{"".join(body)}</PipingNetworkSystem></PlantModel>'


def nodes_of(spark, folder, sheets):
    folder.mkdir()
    for name, text in sheets.items():
        (folder / f"{name}.xml").write_text(text)
    return cut(xml.shred(files.scan_files(spark, str(folder))), "nodes")


def test_two_revisions(spark, tmp_path):
    first = {
        "Q-1": sheet("Q-1", "A", "2024/01/01", gear("V-1", 4), gear("P-1", 2), line("AB-1200101", "2", "GateValve", "CheckValve"), line("AB-1200102", "4", "GlobeValve"), line("AB-1200103", "4", "GateValve", "GateValve")),
        "Q-2": sheet("Q-2", "A", "2024/01/01", gear("V-2", 3), line("AB-1200201", "3", "GateValve", "Strainer", "GateValve")),
    }
    second = {
        # a nozzle more, a new pump, a wider line, a valve more on one line, a new line
        "Q-1": sheet("Q-1", "B", "2024/02/01", gear("V-1", 5), gear("P-1", 2), gear("P-2", 2), line("AB-1200101", "2", "GateValve", "CheckValve"), line("AB-1200102", "6", "GlobeValve"), line("AB-1200104", "1", "GateValve"), line("AB-1200103", "4", "GateValve", "GateValve", "Strainer")),
        "Q-2": sheet("Q-2", "B", "2024/02/01", line("AB-1200201", "3", "GateValve", "Strainer", "GateValve"), gear("V-2", 3)),  # drawn anew only
    }
    old, new = ({k: cut(v, k) for k, v in plant.silver(nodes_of(spark, tmp_path / n, s)).items()} for n, s in (("a", first), ("b", second)))
    rows = [r.asDict() for r in plant.plant_cdc(old, new).select("grain", "anchor", "change_type", "detail").collect()]
    assert not [r for r in rows if "Q-2" in r["anchor"]]
    of = lambda grain: sorted((r["anchor"], r["change_type"], r["detail"]) for r in rows if r["grain"] == grain)
    assert of("equipment") == [("P-2", "New", ""), ("V-1", "Modified", "nozzle_count")]
    # a line's tag has its size, so a wider line is a line that goes and one that comes
    assert of("line") == [("Q-1.xml|1-AB-1200104", "New", ""), ("Q-1.xml|4-AB-1200102", "Deleted", ""), ("Q-1.xml|6-AB-1200102", "New", "")]
    assert of("component") == [
        ("Q-1.xml|1-AB-1200104|GateValve", "New", ""), ("Q-1.xml|4-AB-1200102|GlobeValve", "Deleted", ""), ("Q-1.xml|4-AB-1200103|GateValve", "Modified", "connectivity,flow_direction"),
        ("Q-1.xml|4-AB-1200103|Strainer", "New", ""), ("Q-1.xml|6-AB-1200102|GlobeValve", "New", ""),
    ]
    assert plant.plant_cdc(old, old).count() == 0


def test_headers(spark, tmp_path):
    other = '<PlantModel><PlantInformation Application="DexPI"/><Drawing DrawingNumber="C-9-1">' + generic(OperationCenterDocNo="777Z-9-1", RevRow1No="A", RevRow1Date="01JAN24", RevRow2No="B", RevRow2Date="02FEB24", RevRow3No="") + '</Drawing><PipingNetworkSegment ID="S"/></PlantModel>'
    labels = "".join(f"<Label>{generic(**{'Revision.RevisionNumber': n, 'Revision.TP_RevisionData': d})}</Label>" for n, d in (("A", "2024/01/01"), ("C", "2024/03/01"), ("B", "2024/02/01"), ("D", "2024/03/01")))
    sheets = {"tagged": f'<PlantModel><Drawing Name="55K-1"/>{labels}<PipingNetworkSegment ID="S" TagName="T"/></PlantModel>', "marked": other, "cut": other[:100], "bare": "<PlantModel/>"}
    nodes = nodes_of(spark, tmp_path / "h", sheets)
    got = {r["source_filename"]: r for r in landing.bronze(files.scan_files(spark, str(tmp_path / "h")), nodes, "run").collect()}
    pick = lambda n: tuple(got[f"{n}.xml"][c] for c in ("source_format", "document_number", "client_document_number", "drawing_revision", "drawing_revision_date", "project_code", "header_parse_ok"))
    assert pick("marked") == ("DEXPI", "777Z-9-1", "C-9-1", "B", "02FEB24", "777Z", True)
    assert pick("tagged") == ("POSTPROC", "55K-1", "55K-1", "C", "2024/03/01", "55K", True)
    assert pick("cut") == (None, None, None, None, None, None, False)
    assert pick("bare")[0] is None and not pick("bare")[-1]


def test_landing_twice_inserts_nothing(spark, tmp_path):
    rows = spark.range(10).select(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("content_hash"), F.lit("2024-01-01").cast("date").alias("ingest_date"))
    first = landing.land(rows, str(tmp_path / "t")).first()
    second = landing.land(rows, str(tmp_path / "t")).first()
    assert (first["n_read"], first["n_inserted"], first["n_skipped"]) == (10, 7, 3)
    assert (second["n_inserted"], second["n_skipped"]) == (0, 10) and spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_shred_marks_broken_payloads_and_catalogue(spark):
    docs = [("a", b"<P><ShapeCatalogue><X ID='1'/></ShapeCatalogue><X ID='1'><GenericAttributes><GenericAttribute Name='n' Value=''/><GenericAttribute Name='n' Value='v'/></GenericAttributes></X></P>"), ("b", b"<P><X>"), ("c", b"<P>&#x2;<X ID='2'/></P>"), ("d", None)]
    df = spark.createDataFrame(docs, "path string, content binary")
    got = xml.shred(df).collect()
    assert [(r["document"], r["ord"]) for r in got if r["error"]] == [("b", -1), ("d", -1)]
    assert sorted((r["document"], r["node_id"], r["in_catalogue"], r["ga"].get("n")) for r in got if r["tag"] == "X") == [("a", "1", False, "v"), ("a", "1", True, None), ("c", "2", False, None)]


def test_revision_labels_count_wherever_they_are(spark, tmp_path):
    def late(name, application, n):
        label = "".join(f"<Label>{generic(**{'Revision.RevisionNumber': r, 'Revision.TP_RevisionData': d})}</Label>{'<X/>' * n}" for r, d in (("A", "2024/01/01"), ("B", "2024/02/01")))
        row = f"<Drawing>{generic(RevRow2No='R2')}</Drawing>"
        return f'<PlantModel><PlantInformation Application="{application}"/><Drawing Name="{name}">{generic(RevRow1No="R1")}</Drawing>{label}{row}<PipingNetworkSegment ID="S" TagName="T"/><Note>{generic(OperationCenterDocNo="N-1")}</Note></PlantModel>'

    sheets = {"post": late("post", "Other", 7000), "long": late("long", "Other", 61_000), "dexpi": late("dexpi", "Some Dexpi Tool", 7000), "short": late("short", "Some Dexpi Tool", 10)}
    n = nodes_of(spark, tmp_path / "x", sheets)
    signals = landing.header_signals(n)
    by = {r["drawing_name"]: r for r in signals.collect()}
    assert {k: ({e["number"] for e in r["labels"]}, {e["value"] for e in r["rev_rows"]}, r["operation_doc_no"], r["segment_tagged"]) for k, r in by.items()} == {
        "post": ({"A", "B"}, {"R1", "R2"}, "N-1", True), "long": ({"A", "B"}, {"R1", "R2"}, "N-1", True), "dexpi": ({"A"}, {"R1"}, None, True), "short": ({"A", "B"}, {"R1", "R2"}, "N-1", True),
    }
    got = {r["client_document_number"]: tuple(r)[2:] for r in landing.headers(signals).select("client_document_number", "content_hash", "source_format", "drawing_revision", "drawing_revision_date", "header_parse_ok").collect()}
    assert got == {"post": ("POSTPROC", "B", "2024/02/01", True), "long": ("POSTPROC", "B", "2024/02/01", True), "dexpi": ("DEXPI", "R1", "2024/01/01", True), "short": ("DEXPI", "R2", "2024/02/01", True)}
