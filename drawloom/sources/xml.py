"""XML drawings as a node table: the one Python step, one row per element."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SEGMENT = "PipingNetworkSegment"
CATALOGUE = "ShapeCatalogue"
NODE_SCHEMA = (
    "content_hash string, document string, ord int, node_id string, parent_ord int, parent_id string, owner_segment string, in_catalogue boolean, tag string, "
    "attrs map<string,string>, ga map<string,string>, x double, y double, extent struct<x0:double,y0:double,x1:double,y1:double>, "
    "pts array<struct<x:double,y:double>>, nodes array<struct<name:string,x:double,y:double,dia:string>>, error string"
)
_ILLEGAL = r"&#(?:x0*(?:[0-8bcefBCEF]|1[0-9a-fA-F])|0*(?:[0-8]|1[124-9]|2[0-9]|3[01]));"


def recover_text(content: Column) -> Column:
    """UTF-8 text without character references that XML forbids (control characters)."""
    return F.regexp_replace(F.decode(content, "UTF-8"), _ILLEGAL, "")


def _number(v) -> float | None:
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


def _point(e) -> tuple[float | None, float | None]:
    for at in (c for p in e if p.tag == "Position" for c in p if c.tag == "Location"):
        return _number(at.get("X")), _number(at.get("Y"))
    return None, None


def _describe(e) -> dict:
    """What the element says of itself in its direct children; the first populated value of a name wins."""
    ga: dict[str, str] = {}
    extent, line, ends = None, None, []
    for c in e:
        if c.tag == "GenericAttributes":
            for h in c:
                if h.get("Name") and h.get("Value"):
                    ga.setdefault(h.get("Name"), h.get("Value"))
        elif c.tag == "GenericAttribute":
            if c.get("Name") and c.get("Value"):
                ga.setdefault(c.get("Name"), c.get("Value"))
        elif c.tag == "Extent" and extent is None:
            low, high = c.find("Min"), c.find("Max")
            if low is not None and high is not None:
                extent = {"x0": _number(low.get("X")), "y0": _number(low.get("Y")), "x1": _number(high.get("X")), "y1": _number(high.get("Y"))}
        elif c.tag == "CenterLine" and line is None:
            line = [{"x": _number(p.get("X")), "y": _number(p.get("Y"))} for p in c if p.tag == "Coordinate"]
        elif c.tag == "ConnectionPoints":
            for n in (n for n in c if n.tag == "Node"):
                x, y = _point(n)
                if x is not None and y is not None:
                    dia = n.find("NominalDiameter")
                    ends.append({"name": n.get("Name"), "x": x, "y": y, "dia": None if dia is None else dia.get("Value")})
    x, y = _point(e)
    return {"ga": ga, "x": x, "y": y, "extent": extent, "pts": line, "nodes": ends}


def _elements(root):
    """Elements in document order with their number, parent and whether a symbol definition holds them."""
    todo, n = [(root, None, None, False)], 0
    while todo:
        e, parent, parent_ord, inside = todo.pop()
        yield n, e, parent, parent_ord, inside
        here = inside or e.tag == CATALOGUE
        todo += [(c, e, n, here) for c in reversed(e) if isinstance(c.tag, str)]
        n += 1


_EMPTY = dict.fromkeys(("node_id", "parent_ord", "parent_id", "owner_segment", "in_catalogue", "tag", "attrs", "ga", "x", "y", "extent", "pts", "nodes"))


def shred(files: DataFrame, document: str = "path", content: str = "content", max_elements: int | None = None) -> DataFrame:
    """The node table of XML payloads. A payload that does not parse, even without illegal references, gives one row with ord -1 and its error."""
    text, again = F.decode(F.col(content), "UTF-8"), recover_text(F.col(content))
    rows = files.select(F.concat(F.lit("sha256:"), F.sha2(F.col(content), 256)).alias("content_hash"), F.col(document).alias("document"), text.alias("text"), F.when(again != text, again).alias("again"))
    schema = to_arrow_schema(StructType.fromDDL(NODE_SCHEMA))

    def nodes(out: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in out], f.type, from_pandas=True) for f in schema], schema=schema)

    def run(batches):
        # one payload at a time becomes Python's, however many a batch holds
        for key, doc, text, again in (tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows)):
            try:
                try:
                    root = ET.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", text))
                except ET.ParseError:
                    if again is None:
                        raise
                    root = ET.fromstring(re.sub(r"^\s*<\?xml[^>]*\?>", "", again))
            except Exception as e:  # a payload may be anything; its row says what is wrong
                yield nodes([{"content_hash": key, "document": doc, "ord": -1, **_EMPTY, "error": str(e)[:500]}])
                continue
            out = []
            for n, e, parent, parent_ord, inside in _elements(root):
                if max_elements is not None and n >= max_elements:
                    break
                about = _describe(e)
                out.append({
                    "content_hash": key, "document": doc, "ord": n, "node_id": e.get("ID"), "parent_ord": parent_ord, "parent_id": None if parent is None else parent.get("ID"),
                    "owner_segment": parent.get("ID") if parent is not None and parent.tag == SEGMENT else None, "in_catalogue": inside, "tag": e.tag, "attrs": list(e.attrib.items()), **about, "ga": list(about["ga"].items()), "error": None,
                })
                if len(out) == 5000:
                    yield nodes(out)
                    out = []
            if out:
                yield nodes(out)

    return rows.mapInArrow(run, NODE_SCHEMA)


def instances(nodes: DataFrame) -> DataFrame:
    """Elements outside symbol definitions."""
    return nodes.where("error is null and not in_catalogue")
