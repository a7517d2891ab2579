"""What a set of outcome dependencies implies: closure, equivalence cycles and contradictions.

Each relation is a set of implications between literals, an outcome being true or false:

=============  =======================================
``implies``     a -> b (and so not b -> not a)
``equivalent``  a -> b, b -> a
``mutex``       a -> not b
``complement``  a -> not b, not a -> b
=============  =======================================

The other relation types say nothing about single outcomes and are left out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import work_folder
from marketlake.sinks.tables import write_parquet

_LITERALS = """inline(CASE relationship_type
  WHEN 'implies' THEN array({ab}, {nb_na})
  WHEN 'equivalent' THEN array({ab}, {nb_na}, {ba}, {na_nb})
  WHEN 'mutex' THEN array({a_nb}, {b_na})
  WHEN 'complement' THEN array({a_nb}, {b_na}, {na_b}, {nb_a})
END)"""


def implications(dependencies: DataFrame) -> DataFrame:
    """(src, dst): implied literals, an outcome id behind ``+`` (true) or ``-`` (false)."""
    sides = {"a": "'+' || outcome_id_a", "b": "'+' || outcome_id_b", "na": "'-' || outcome_id_a", "nb": "'-' || outcome_id_b"}

    def edge(src: str, dst: str) -> str:
        return f"named_struct('src', {sides[src]}, 'dst', {sides[dst]})"

    pairs = {f"{x}_{y}": edge(x, y) for x in sides for y in sides}
    text = _LITERALS.format(ab=pairs["a_b"], ba=pairs["b_a"], **pairs)
    return dependencies.selectExpr(text).filter("src <> dst").distinct()


def closure(edges: DataFrame) -> DataFrame:
    """(src, dst): every pair that a path of one or more edges connects.

    Semi-naive: a round extends only the pairs that the round before found, and drops what is
    known already.  Each round is stored, so the plan doesn't grow and a lost executor costs
    one round.  The rounds are as many as the longest shortest path.  The result itself can
    have as many rows as there are pairs; nothing is collected and no pair is left out.
    """
    spark = edges.sparkSession
    base = work_folder(spark, spark.conf.get("spark.sql.warehouse.dir"))
    root, turn = f"{base}/marketlake/closure-{uuid.uuid4().hex}", 0
    edges = write_parquet(edges, f"{root}/edges")
    onward = edges.selectExpr("src AS _via", "dst AS _next")
    fresh = edges
    write_parquet(edges, f"{root}/known/0")
    while not fresh.isEmpty():
        turn += 1
        known = spark.read.schema(edges.schema).parquet(*[f"{root}/known/{t}" for t in range(turn)])
        longer = fresh.join(onward, F.col("dst") == F.col("_via")).select("src", F.col("_next").alias("dst")).distinct()
        fresh = write_parquet(longer.join(known, ["src", "dst"], "left_anti"), f"{root}/known/{turn}")
    return spark.read.schema(edges.schema).parquet(*[f"{root}/known/{t}" for t in range(turn + 1)])


def derived_relations(reach: DataFrame) -> DataFrame:
    """(outcome_id_a, outcome_id_b, relation) of different outcomes, from a closure.

    ``implies`` holds both ways inside a cycle (equivalence); ``mutex`` and ``covers`` (one
    of the two is true) are symmetric, ``complement`` is both of them.
    """
    a, b = "substring(src, 2)", "substring(dst, 2)"
    pairs = reach.filter(f"{a} <> {b}").selectExpr(
        f"{a} AS outcome_id_a", f"{b} AS outcome_id_b", "substring(src, 1, 1) || substring(dst, 1, 1) AS signs"
    )
    relation = "CASE signs WHEN '++' THEN 'implies' WHEN '+-' THEN 'mutex' WHEN '-+' THEN 'covers' END"
    return pairs.filter("signs <> '--'").selectExpr("outcome_id_a", "outcome_id_b", f"{relation} AS relation")


def contradictions(reach: DataFrame) -> DataFrame:
    """(outcome_id, conflict): outcomes that imply their own negation.

    ``never true`` and ``never false`` fix an outcome; ``contradiction`` is both, so the
    dependencies cannot all hold.
    """
    own = reach.filter("substring(src, 2) = substring(dst, 2) AND src <> dst")
    kinds = own.groupBy(F.expr("substring(src, 2)").alias("outcome_id")).agg(F.min("src").alias("least"), F.max("src").alias("most"))
    kind = "CASE WHEN least < most THEN 'contradiction' WHEN least LIKE '+%' THEN 'never true' ELSE 'never false' END AS conflict"
    return kinds.selectExpr("outcome_id", kind)


def equivalence_cycles(reach: DataFrame) -> DataFrame:
    """(outcome_id, cycle): outcomes on a cycle of implications, and the least outcome on it."""
    true = reach.filter("src LIKE '+%' AND dst LIKE '+%'")
    back = true.selectExpr("dst AS src", "src AS dst")
    both = true.intersect(back)
    return both.groupBy(F.expr("substring(src, 2)").alias("outcome_id")).agg(
        F.least(F.expr("substring(min(src), 2)"), F.expr("substring(min(dst), 2)")).alias("cycle")
    )
