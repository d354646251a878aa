"""Readers for exported graph text.

Vertex lines look like ``label[gid]{json}``; edge lines like
``"start","LABEL","end"[,mgm]`` with ``\\N`` for null. Every reader is a
plain projection over ``spark.read.text`` (no shuffle, splittable, column
pruned); bad lines are not thrown away silently: each reader is a parse
with an ``error`` column, whose rows without an error are the reader's
output and whose other rows are its rejects, so the two never disagree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import drop_blank_label
from ..functions.scalar import field, java_split, label_of, parse_int, strip_quotes
from ..schema import CALL, NULL_MARK


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One row per line (``value``); HDFS-style globs allowed."""
    return spark.read.text(path)


def _line_col(lines: DataFrame) -> Column:
    return F.col("value") if "value" in lines.columns else F.col(lines.columns[0])


# --------------------------------------------------------------------------- vertices
def parse_vertex_lines(lines: DataFrame, *carried: str) -> DataFrame:
    """Parse vertex lines into (line, label, gid, attrs, error), one row per line.

    label = text before the first ``[``, upper-cased; gid = text inside the
    brackets; attrs = the JSON object from the first ``{`` as
    map<string,string> (numbers and booleans as their text, JSON nulls
    dropped: a null property is an absent one).
    """
    line = _line_col(lines)
    has_bracket = F.instr(line, "[") > 0
    brace = F.instr(line, "{")
    raw = F.from_json(F.when(brace > 0, F.substr(line, brace)), "map<string,string>")  # rest of the line
    attrs = F.map_filter(raw, lambda k, v: v.isNotNull())
    gid = F.regexp_extract(line, r"\[([^\]]*)\]", 1)
    error = (F.when(~has_bracket, F.lit("no label bracket"))
             .when(brace == 0, F.lit("no attributes"))
             .when(raw.isNull(), F.lit("bad json")))
    return lines.select(
        line.alias("line"),
        label_of(line).alias("label"),
        F.when(has_bracket, gid).alias("gid"),
        attrs.alias("attrs"),
        error.alias("error"),
        *carried,
    )


def ingest_vertices(lines: DataFrame, keep_blank_labels: bool = False) -> DataFrame:
    """S2 (+F7): (label, gid, attrs) for every well-formed vertex line.

    A line with an empty label (``[1.1]{...}``) is skipped, as the loader
    skips records with a blank label.
    """
    parsed = parse_vertex_lines(lines).where(F.col("error").isNull())
    if not keep_blank_labels:
        parsed = parsed.where(drop_blank_label("label"))
    return parsed.select("label", "gid", "attrs")


def vertex_line_errors(lines: DataFrame) -> DataFrame:
    """Rejected vertex lines with the reason."""
    return parse_vertex_lines(lines).where(F.col("error").isNotNull()).select("line", "error")


def with_load_errors(parsed: DataFrame, labels) -> DataFrame:
    """Parsed vertex lines, with the reasons that only a load has to refuse a line for.

    A blank label is skipped by the reader, a label outside ``labels`` has no staged table, and a vertex
    without a name can have no id: all three become rejects instead of vanishing.
    """
    extra = (F.when(~drop_blank_label("label"), F.lit("blank label"))
             .when(~F.col("label").isin(*labels), F.lit("unknown label"))
             .when(F.col("attrs").getItem("name").isNull(), F.lit("no name")))
    return parsed.withColumn("error", F.coalesce("error", extra))


# --------------------------------------------------------------------------- edges
#: a line as the export writes it, without a comma inside its quotes
_PLAIN_LINE = '^"[^",]*","[^",]*","[^",]*"(,[^",]*)?$'


def parse_edge_lines(lines: DataFrame, *carried: str) -> DataFrame:
    """Parse edge lines into (line, fields, n_fields, quoted_comma), with the ``carried`` columns.

    All double quotes are stripped and the text split naively on commas,
    counting fields the JVM way (trailing empty fields dropped). A comma
    inside a quoted field would shift the fields, so such lines are flagged
    (``quoted_comma``) and treated as bad records.
    """
    line = _line_col(lines)
    fields = java_split(strip_quotes(line), ",")
    quoted = F.regexp_extract_all(line, F.lit('"([^"]*)"'), 1)
    quoted_comma = (F.instr(line, '"') > 0) & F.exists(quoted, lambda x: F.instr(x, ",") > 0)
    quoted_comma = F.when(line.rlike(_PLAIN_LINE), F.lit(False)).otherwise(quoted_comma)  # nearly all: one match, no lists
    return lines.select(line.alias("line"), fields.alias("fields"), F.size(fields).alias("n_fields"),
                        quoted_comma.alias("quoted_comma"), *carried)


def only_label(edge_lines: DataFrame, label: str) -> DataFrame:
    """Edge lines whose second field is ``label`` (quotes ignored, case-insensitive).

    For an export that holds several edge labels in one file.
    """
    line = _line_col(edge_lines)
    second = F.get(F.split(strip_quotes(line), ","), 1)
    return edge_lines.where(F.upper(second) == label)


def _mgm_text() -> Column:
    """The fourth field as text, or null when it is missing, empty or ``\\N``."""
    raw = field("fields", 3)
    return F.when((raw != NULL_MARK) & (F.length(raw) > 0), raw)


def parse_edge_rows(lines: DataFrame, reader: str = "plain", *carried: str) -> DataFrame:
    """(line, start_name, label, end_name, mgm, error) as one of the three readers sees the lines.

    ``plain`` (S3) has no mgm. ``call`` (S4) reads the fourth field of every line. ``labelled`` (S5) reads it
    only if the line has exactly four fields and the label is CALL. A reader refuses a line for an mgm
    that is no integer only if it reads that mgm.
    """
    p = parse_edge_lines(lines, *carried)
    label = F.upper(field("fields", 1))
    reads = {"plain": F.lit(False), "call": F.lit(True),
             "labelled": (F.col("n_fields") == 4) & F.coalesce(label == CALL, F.lit(False))}[reader]
    text = F.when(reads, _mgm_text())
    mgm = parse_int(text)
    error = (F.when(F.col("quoted_comma"), F.lit("comma inside quotes"))
             .when(F.col("n_fields") < 3, F.lit("too few fields"))
             .when(text.isNotNull() & mgm.isNull(), F.lit("bad mgm")))
    return p.select("line", field("fields", 0).alias("start_name"), label.alias("label"),
                    field("fields", 2).alias("end_name"), mgm.alias("mgm"), error.alias("error"), *carried)


def _good(lines: DataFrame, reader: str) -> DataFrame:
    return parse_edge_rows(lines, reader).where(F.col("error").isNull())


def ingest_edges(lines: DataFrame) -> DataFrame:
    """S3: (start_name, label, end_name) from fields 0, 1 and 2."""
    return _good(lines, "plain").select("start_name", "label", "end_name")


def ingest_call_edges(lines: DataFrame) -> DataFrame:
    """(start_name, end_name, mgm); ``\\N``, empty or missing mgm is null, a non-integer is a bad record."""
    return _good(lines, "call").select("start_name", "end_name", "mgm")


def ingest_labelled_edges(lines: DataFrame) -> DataFrame:
    """(start_name, label, end_name, mgm).

    mgm is kept only when the line has exactly four fields, the label is
    CALL and the fourth field is not ``\\N``.
    """
    return _good(lines, "labelled").select("start_name", "label", "end_name", "mgm")


def edge_line_errors(lines: DataFrame, reader: str = "call") -> DataFrame:
    """The lines that the reader refuses, with the reason."""
    return parse_edge_rows(lines, reader).where(F.col("error").isNotNull()).select("line", "error")
