"""Random small graphs: Spark adjacency lines == a plain-Python statement of the format,
and decoding the lines gives the edges back."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from edgeloom.operators.adjacency import (build_adjacency, decode_edges, decode_vertices, encode_adjacency,
                                          vertex_records)
from edgeloom.schema import DEVICE_COLUMNS, EDGE_ENDPOINTS, MOBILE_COLUMNS

LABELS = ("MOBILE", "DEVICE", "WIFI")
flag = st.sampled_from([None, "true", "false"])
small_int = st.one_of(st.none(), st.integers(-3, 12))


@st.composite
def graphs(draw):
    n = {lab: draw(st.integers(0, 4)) for lab in LABELS}
    ids = {}
    next_id = 1
    vertices = {}
    for lab in LABELS:
        rows = []
        for _ in range(n[lab]):
            vid = next_id
            next_id += draw(st.integers(1, 5000))  # sparse ids
            name = f"{lab[0]}{vid}"
            if lab == "MOBILE":
                rows.append((vid, name, name, "h", draw(flag), draw(flag), None, draw(flag), draw(st.sampled_from([None, "A", "B"])),
                             draw(small_int), draw(small_int), draw(small_int)))
            else:
                rows.append((vid, name, draw(flag), draw(flag)))
        vertices[lab] = rows
        ids[lab] = [r[0] for r in rows]
    edges = []
    for label, (src, dst) in EDGE_ENDPOINTS.items():
        if not ids[src] or not ids[dst]:
            continue
        k = draw(st.integers(0, 6))
        for _ in range(k):
            s = draw(st.sampled_from(ids[src]))
            d = draw(st.sampled_from(ids[dst]))
            mgm = draw(small_int) if label == "CALL" else None
            edges.append((label, s, d, mgm))
    edges += draw(st.lists(st.sampled_from(edges), max_size=3)) if edges else []  # repeated copies
    return vertices, edges


def python_lines(vertices, edges):
    """The line format stated directly."""
    def txt(x):
        return "" if x is None else str(x)

    out_e, in_e = defaultdict(list), defaultdict(list)
    for label, s, d, mgm in edges:
        src, dst = EDGE_ENDPOINTS[label]
        tail = "," + txt(mgm) if label == "CALL" else ""
        out_e[(s, src)].append((label, d, f"{label},{d}{tail}"))
        in_e[(d, dst)].append((label, s, f"{label},{s}{tail}"))
    lines = []
    for lab, rows in vertices.items():
        for r in rows:
            props = ",".join(txt(x) for x in r[1:])
            ins = "|".join(e[2] for e in sorted(in_e[(r[0], lab)]))
            outs = "|".join(e[2] for e in sorted(out_e[(r[0], lab)]))
            lines.append(f"{r[0]},{lab},{props}\t{ins}\t{outs}")
    return sorted(lines)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(graphs())
def test_adjacency_matches_python(spark, g):
    vertices, edges = g
    mschema = "id bigint, " + ", ".join(f"{c} {'int' if c in ('status', 'suspect_risk', 'overdue_status') else 'string'}"
                                        for c in MOBILE_COLUMNS)
    dschema = "id bigint, " + ", ".join(f"{c} string" for c in DEVICE_COLUMNS)
    v = {lab: spark.createDataFrame(rows, mschema if lab == "MOBILE" else dschema) for lab, rows in vertices.items()}
    e = spark.createDataFrame(edges, "label string, start_id bigint, end_id bigint, mgm int")
    for degree in (2, 1000):  # some vertices hubs, and none
        lines = encode_adjacency(build_adjacency(vertex_records(v), e, hub_degree=degree))
        assert sorted(r.line for r in lines.collect()) == python_lines(vertices, edges)
    text = lines.selectExpr("line as value")
    assert sorted(map(tuple, decode_edges(text).collect()), key=repr) == sorted(edges, key=repr)
    assert decode_vertices(text).count() == sum(len(r) for r in vertices.values())
