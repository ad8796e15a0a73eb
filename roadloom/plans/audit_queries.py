"""Decisions about pairs over the driver's tables; the stages' verdicts are derived from arc ids."""

from __future__ import annotations

from ..functions import scalars
from ..operators import assembly
from ..sources import views as v
from .network_queries import ARC
from .registry import query

STAGES = ["gate", "support", "slot"]
REGISTRY = "edge_id AS arc_id, edge_id % 5 = 0 AS built, edge_id % 4 = 0 AS entry_allowed, edge_id % 3 = 0 AS entered, CASE WHEN edge_id % 7 = 0 THEN 'blocked' ELSE '' END AS hard_block, CASE WHEN edge_id % 2 = 0 THEN 'gate' END AS unbuilt_stage, CASE WHEN edge_id % 2 = 0 THEN 'no_slot' END AS unbuilt_reason"
SEGMENTS = "edge_id AS segment_id, edge_id % 2 = 0 AS direct_legal, edge_id % 3 = 0 AS is_unique, edge_id % 5 AS pair_rank, edge_id % 11 AS support"
EXCLUDED = "edge_id AS candidate_id, CASE edge_id % 4 WHEN 0 THEN 'slot' WHEN 1 THEN 'gate' WHEN 2 THEN 'support' ELSE 'other' END AS stage, CASE WHEN edge_id % 3 = 0 THEN 'thin' ELSE 'far' END AS reason"


@query(
    f"""{ARC}, rg AS (SELECT src, dst, {REGISTRY} FROM ae), r AS (SELECT *, count(*) OVER (PARTITION BY src, dst) AS n_arcs FROM rg QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY built DESC, entry_allowed DESC, entered DESC, arc_id) = 1),
    sg AS (SELECT src, dst, {SEGMENTS} FROM ae WHERE length_m > 38), g AS (SELECT * FROM sg QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY direct_legal DESC, is_unique DESC, pair_rank, support DESC, segment_id) = 1),
    ex AS (SELECT src, dst, {EXCLUDED} FROM ae WHERE length_m < 20), x AS (SELECT * FROM ex QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY CASE stage WHEN 'gate' THEN 1 WHEN 'support' THEN 2 WHEN 'slot' THEN 3 ELSE 4 END, reason, candidate_id) = 1),
    b AS (SELECT DISTINCT a.src, c.dst FROM ae a JOIN ae c ON c.src = a.dst WHERE a.src <> c.dst), s AS (SELECT DISTINCT dst AS src, src AS dst FROM ae), p AS (SELECT src, dst FROM ae UNION SELECT src, dst FROM b)
    SELECT src, dst, coalesce(n_arcs, 0) AS n_arcs, arc_id, segment_id, coalesce(built, false) AS built, coalesce(entered, false) AS entered, segment_id IS NOT NULL AS selected,
      CASE WHEN NOT coalesce(built, false) AND NOT coalesce(entered, false) AND segment_id IS NULL THEN coalesce(x.stage, unbuilt_stage, CASE WHEN b.src IS NOT NULL THEN 'bridge' END) END AS reject_stage,
      CASE WHEN NOT coalesce(built, false) AND NOT coalesce(entered, false) AND segment_id IS NULL THEN coalesce(x.reason, nullif(hard_block, ''), unbuilt_reason, CASE WHEN b.src IS NOT NULL THEN 'two_hops' END) END AS reject_reason,
      CASE WHEN s.src IS NOT NULL THEN 'reverse_arc' END AS should_not_reason
    FROM p LEFT JOIN r USING (src, dst) LEFT JOIN g USING (src, dst) LEFT JOIN x USING (src, dst) LEFT JOIN b ON b.src = p.src AND b.dst = p.dst LEFT JOIN s ON s.src = p.src AND s.dst = p.dst""",
    ("v_roads",),
)
def pair_decision_audit(spark, d):
    arcs = scalars.arc_edges_of(v.roads(spark, d)).select("src", "dst", "edge_id", "length_m")
    take = lambda df, cols: df.selectExpr("src", "dst", *_split(cols))
    hop = arcs.selectExpr("src AS a", "dst AS src").join(arcs.select("src", "dst"), "src").where("a <> dst").selectExpr("a AS src", "dst").distinct()
    back = arcs.selectExpr("dst AS src", "src AS dst", "'reverse_arc' AS reason")
    return assembly.pair_decision_audit(
        arcs.select("src", "dst").union(hop), take(arcs, REGISTRY), take(arcs.where("length_m > 38"), SEGMENTS), take(arcs.where("length_m < 20"), EXCLUDED),
        hop.selectExpr("src", "dst", "'bridge' AS stage", "'two_hops' AS reason"), back, STAGES,
    )


def _split(columns: str) -> list[str]:
    return columns.split(", ")
