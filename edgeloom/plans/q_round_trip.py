"""Registered queries that write through a sink and read the result back, and the rejects of load and encode."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.adjacency import (build_adjacency, decode_vertices, encode_adjacency, encode_rejects, missing_halves,
                                   vertex_records)
from ..schema import CALL, DEVICE, MOBILE
from ..session import freeze, fresh_folder
from ..sinks.tables import create_table_as, insert_overwrite, read_in_edges, read_snapshot, replace_table
from ..sinks.text import export_edges, export_vertices, write_adjacency_text, write_csv, write_lines
from ..sinks.versions import current_version, publish_snapshot
from ..sources.tables import base_table, read_table, rows_to_df
from ..sources.text import ingest_call_edges, ingest_vertices, read_lines
from . import fixtures as fx
from .catalog import register
from .pipeline import load_graph, stage_all
from .q_load import adjacency_lines, edge_lines, graph, vertex_lines


@register("round_trip_adjacency_text", "select line from adj_lines")
def q_round_trip_adjacency_text(spark, sf_dir):
    """Adjacency lines to text files and back."""
    path = fresh_folder(spark, "adjacency")
    write_adjacency_text(adjacency_lines(spark, sf_dir), path)
    return read_lines(spark, path).select(F.col("value").alias("line"))


@register("round_trip_call_text", "select start_name, end_name, mgm from call_e")
def q_round_trip_call_text(spark, sf_dir):
    """Exported CALL lines to text files, read as edges."""
    path = fresh_folder(spark, "call")
    write_lines(export_edges(fx.call(spark, sf_dir), CALL), path)
    return ingest_call_edges(read_lines(spark, path))


@register("round_trip_csv", "select name, is_exception, is_white from device")
def q_round_trip_csv(spark, sf_dir):
    """K5: CSV parts with headers and back, nulls apart from empty strings."""
    path = fresh_folder(spark, "csv")
    rows = fx.device(spark, sf_dir, with_key=False)
    write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@register("round_trip_tables", """
select name, 'created' as step from mobile union all select name, 'replaced' from wifi_raw
union all select concat(name, '!'), 'overwritten' from wifi_raw
""")
def q_round_trip_tables(spark, sf_dir):
    """Create, replace, and overwrite a table by a query that reads it."""
    tag = uuid.uuid4().hex[:12]
    made, replaced, over = f"el_made_{tag}", f"el_replaced_{tag}", f"el_over_{tag}"
    create_table_as(fx.mobile(spark, sf_dir).select("name"), made)
    replace_table(fx.mobile(spark, sf_dir).select("name"), replaced)
    replace_table(fx.wifi(spark, sf_dir).select("name"), replaced, bucket_by=("name",), buckets=4)
    create_table_as(fx.wifi(spark, sf_dir).select("name"), over)
    insert_overwrite(read_table(spark, over).select(F.concat("name", F.lit("!")).alias("name")), over)
    steps = [read_table(spark, t).select("name", F.lit(s).alias("step"))
             for t, s in ((made, "created"), (replaced, "replaced"), (over, "overwritten"))]
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@register("round_trip_rows", "select label, k as id, name from vertex")
def q_round_trip_rows(spark, sf_dir):
    """A small table of label codes as in-memory rows, joined with every vertex line of that code."""
    codes = rows_to_df(spark, [("10", "DEVICE"), ("11", "MOBILE"), ("12", "WIFI")], "code string, label string")
    v = ingest_vertices(vertex_lines(spark, sf_dir)).withColumn("code", F.substring_index("gid", ".", 1))
    return v.drop("label").join(codes, "code").select(
        "label", F.substring_index("gid", ".", -1).cast("bigint").alias("id"), F.col("attrs")["name"].alias("name"))


@register("round_trip_snapshot", """
select 'out' as side, label, start_id, end_id, mgm from edges union all select 'in', label, start_id, end_id, mgm from edges
""")
def q_round_trip_snapshot(spark, sf_dir):
    """A published snapshot: both edge layouts hold every edge."""
    g, base = graph(spark, sf_dir), fresh_folder(spark, "graph")
    publish_snapshot(spark, base, g.wide_vertices(), g.edges, vertices_stored=True)
    path = current_version(spark, base)
    _, out = read_snapshot(spark, path)
    return out.select(F.lit("out").alias("side"), "*").unionByName(
        read_in_edges(spark, path).select(F.lit("in").alias("side"), "*"))


@register("blank_labels", "select name from mobile where k % 2 = 1")
def q_blank_labels(spark, sf_dir):
    """every second exported line loses its label and is skipped."""
    m = fx.mobile(spark, sf_dir, with_key=True)
    lines = export_vertices(m, MOBILE).select(F.when(
        F.regexp_extract("line", r"\[11\.(\d+)\]", 1).cast("bigint") % 2 == 0, F.regexp_replace("line", "^mobile", "")
    ).otherwise(F.col("line")).alias("value"))
    return ingest_vertices(lines).select(F.col("attrs")["name"].alias("name"))


# document texts, one line each, as the junk that a load meets: by id a good line, no label, no attributes,
# broken JSON, an unknown label, a nameless vertex; and as edges a good one, too few fields, a quoted comma
_JUNK = r"""
flat AS (select doc_id, regexp_replace(coalesce(text, ''), '[\r\n"\\\[\]{}]', ' ', 'g') as t from documents)
"""


def _flat(spark, sf_dir):
    d = base_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), r'[\r\n"\\\[\]{}]', " ").alias("t"))


def _junk_lines(spark, sf_dir):
    d, k, gid = _flat(spark, sf_dir), F.col("doc_id") % 6, F.concat(F.lit("11."), F.col("doc_id").cast("string"))
    named = F.concat(F.lit(']{"name":"doc'), F.col("doc_id").cast("string"), F.lit('","merchant_name":"'), "t", F.lit('"}'))
    vertex = (F.when(k == 0, F.concat(F.lit("mobile["), gid, named)).when(k == 1, F.col("t"))
              .when(k == 2, F.concat(F.lit("mobile["), gid, F.lit("]"), "t"))
              .when(k == 3, F.concat(F.lit("mobile["), gid, F.lit(']{"name":'), "t"))
              .when(k == 4, F.concat(F.lit("router["), gid, named))
              .otherwise(F.concat(F.lit("mobile["), gid, F.lit(']{"merchant_name":"'), "t", F.lit('"}'))))
    edge = (F.when(k < 2, F.concat(F.lit('"doc0","CALL","doc6",'), (F.col("doc_id") % 9).cast("string")))
            .when(k == 2, F.lit('"doc0","CALL"')).when(k == 3, F.concat(F.lit('"doc0, '), "t", F.lit('","CALL","doc6",1')))
            .when(k == 4, F.lit('"doc0","CALL","doc6",x')).otherwise(F.lit('"doc0","CALL","nobody",1')))
    return d.select(vertex.alias("value")), {CALL: d.select(edge.alias("value"))}


@register("load_rejects", r"""
select 'vertices' as source, case doc_id % 6 when 1 then t when 2 then concat('mobile[11.', doc_id, ']', t)
    when 3 then concat('mobile[11.', doc_id, ']{"name":', t)
    when 4 then concat('router[11.', doc_id, ']{"name":"doc', doc_id, '","merchant_name":"', t, '"}')
    else concat('mobile[11.', doc_id, ']{"merchant_name":"', t, '"}') end as line,
  ['no label bracket', 'no attributes', 'bad json', 'unknown label', 'no name'][doc_id % 6] as error
from flat where doc_id % 6 <> 0
union all
select 'edges', case doc_id % 6 when 2 then '"doc0","CALL"' when 3 then concat('"doc0, ', t, '","CALL","doc6",1')
    else '"doc0","CALL","doc6",x' end, ['too few fields', 'comma inside quotes', 'bad mgm'][doc_id % 6 - 1]
from flat where doc_id % 6 in (2, 3, 4)
""", extra_ctes=_JUNK)
def q_load_rejects(spark, sf_dir):
    return stage_all(*_junk_lines(spark, sf_dir)).rejects


@register("load_beside_rejects", """
select name, merchant_name, (select count(*) from documents where doc_id % 6 < 2) as n_edges
from (select concat('doc', doc_id) as name, t as merchant_name from flat where doc_id % 6 = 0)
""", extra_ctes=_JUNK)
def q_load_beside_rejects(spark, sf_dir):
    g = stage_all(*_junk_lines(spark, sf_dir))
    n = g.edges.agg(F.count(F.lit(1)).alias("n_edges"))
    return g.vertices[MOBILE].select("name", "merchant_name", n.scalar().alias("n_edges"))


def _document_vertices(spark, sf_dir):
    """Each document as a DEVICE whose flag is its whole text, with whatever separators it holds."""
    d = base_table(spark, sf_dir, "documents")
    return {DEVICE: d.select(F.col("doc_id").alias("id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("name"),
                             F.col("text").alias("is_exception"), F.lit(None).cast("string").alias("is_white"))}


def _document_adjacency(spark, sf_dir):
    no_edges = spark.createDataFrame([], "label string, start_id bigint, end_id bigint, mgm int")
    return build_adjacency(vertex_records(_document_vertices(spark, sf_dir)), no_edges)


@register("encode_rejects", r"""
select doc_id as id, 'DEVICE' as label, if(regexp_matches(text, '[,\t\n\r]'), 'separator in a value', 'blank value') as error
from documents where regexp_matches(text, '[,\t\n\r]') or (text <> '' and trim(text) = '')
""")
def q_encode_rejects(spark, sf_dir):
    return encode_rejects(_document_adjacency(spark, sf_dir))


@register("encode_accepted", r"""
select doc_id as id, concat('d', doc_id) as name, nullif(text, '') as is_exception from documents
where not coalesce(regexp_matches(text, '[,\t\n\r]') or (text <> '' and trim(text) = ''), false)
""")
def q_encode_accepted(spark, sf_dir):
    """What is accepted reads back as the same values."""
    lines = encode_adjacency(_document_adjacency(spark, sf_dir)).select(F.col("line").alias("value"))
    return decode_vertices(lines).select("id", "name", "is_exception")


@register("missing_halves", """
select 'CALL' as label, 'out' as dir, count(*) as n from edges where label = 'CALL'
union all select 'CALL', 'in', count(*) from edges where label = 'CALL'
union all select 'USE', 'out', count(*) from edges where label = 'USE'
union all select 'USE_WIFI', 'out', count(*) from edges where label = 'USE_WIFI'
union all select 'HAS', 'in', count(*) from edges where label = 'HAS'
""")
def q_missing_halves(spark, sf_dir):
    """The halves a fold leaves out when the mobiles are not there."""
    g = graph(spark, sf_dir)
    return missing_halves(g.wide_vertices().where(F.col("label") != MOBILE), g.edges)


@register("remaining_conflicts", "select name, 2::bigint as count from mobile where k % 7 = 0")
def q_remaining_conflicts(spark, sf_dir):
    """The gate before loading: DEVICE and MOBILE share names, which the removal from WIFI cannot mend."""
    v, e = fx.staged_vertices(spark, sf_dir), fx.staged_edges(spark, sf_dir)
    shared = fx.mobile(spark, sf_dir, with_key=True).where(F.col("k") % 7 == 0).select(
        "name", *[F.lit(None).cast("string").alias(c) for c in ("is_exception", "is_white")])
    return load_graph({**v, DEVICE: v[DEVICE].unionByName(shared)}, e).remaining


@register("round_trip_edge_text", "select count(*) as n from named")
def q_round_trip_edge_text(spark, sf_dir):
    """S1 over several files by a glob: every exported edge line is read once, as it was written.

    Counts the lines that come back equal, less those that come back and were not written (or not as often),
    so any garbled, lost or additional line shows in the number.
    """
    path = fresh_folder(spark, "edges")
    # the edges are stored once: their lines are printed twice, to be written and to be compared with
    edges = {label: freeze(e, "staged-edges") for label, e in fx.staged_edges(spark, sf_dir).items()}
    exported = {label: export_edges(e, label).withColumnRenamed("line", "value") for label, e in edges.items()}
    for label, lines in exported.items():
        write_lines(lines.withColumnRenamed("value", "line"), f"{path}/{label}")
    sides = [lines.select("value", F.lit(1).alias("wrote"), F.lit(0).alias("got")) for lines in exported.values()]
    sides.append(read_lines(spark, f"{path}/*").select("value", F.lit(0).alias("wrote"), F.lit(1).alias("got")))
    lines = reduce(DataFrame.unionByName, sides).groupBy("value").agg(F.sum("wrote").alias("wrote"), F.sum("got").alias("got"))
    equal, extra = F.least("wrote", "got"), F.greatest(F.col("got") - F.col("wrote"), F.lit(0))
    return lines.agg(F.coalesce(F.sum(equal - extra), F.lit(0)).alias("n"))
