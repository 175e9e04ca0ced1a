"""Person identity: equivalence edges to one canonical id per person.

Edges are DataFrames ``(a PERSON, b PERSON)``. Person ids are structs whose order is
the union order (cookies before user ids), so ``min``/``least`` pick the same
"smallest id" as the fact model.

Two fixpoints compute the same map ``id -> smallest id of its connected component``:

* :func:`equiv_fixpoint` repeats the relinking round :func:`equiv_round` until a
  round makes no progress; its result is the last round's edge set (stars).
* :func:`canonical_ids` (default ``method="star"``) alternates the large-star and
  small-star steps of Kiveris et al., "Connected Components in MapReduce and
  Beyond" (SoCC 2014). The edge count never grows, which bounds shuffle volume on
  graphs where the relinking round would multiply edges before shrinking them.

No step collects a neighbour list: per-node facts come from ``min``/``max``
aggregates (partial aggregation before the shuffle, so a hub node costs one row per
map task) joined back to the edges. Inside a fixpoint these facts are written first, so
both sides of the join come from a shuffle of their own and AQE's skew join can split a
hub's edges across tasks; a round of fewer edges than ``SPLIT_ROWS``, which one task could
join alone, is spared that job. Each round's output is written as a Parquet table in the shared checkpoint
folder (or cut by a reliable checkpoint), so a lost executor recomputes at most one
round, and the next round's joins are planned from real table sizes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lamina import schema as S
from lamina.functions.facts import only_unit, set_nested
from lamina.session import default_stage, parquet_stage, workspace

# A round of at most so many edges fits one task whatever its largest hub, so its
# per-node facts need no table of their own (see the module's text).
SPLIT_ROWS = 1 << 20

# A side of a join with more rows than this is shuffled. By its file size the planner would
# send a table of ten times as many ids to the driver and every executor, in each round.
BROADCAST_ROWS = 1 << 13

# Loop guard only: a fixpoint that has not converged raises, it never returns a
# partial map. Both methods need O(log n)-O(log^2 n) rounds.
MAX_ROUNDS = 256

Stage = Callable[[DataFrame, str], DataFrame]


class FixpointError(RuntimeError):
    """Raised when a fixpoint does not converge within its round budget."""


def shuffled(side: DataFrame, rows: int | None = None) -> DataFrame:
    """The side of a join, never broadcast if it has more than ``BROADCAST_ROWS`` rows. ``rows``: at
    least as many as it has; by default a written table's rows are counted, from its footers."""
    return side if (side.count() if rows is None else rows) <= BROADCAST_ROWS else side.hint("merge")


# --- P2, P7, G1 --------------------------------------------------------------------


def equiv_pairs(facts: DataFrame) -> DataFrame:
    """Project equiv facts to edges ``(a, b)``."""
    return facts.where(F.col("dataunit.equiv").isNotNull()).select(
        F.col("dataunit.equiv.id1").alias("a"), F.col("dataunit.equiv.id2").alias("b")
    )


def drop_self_loops(edges: DataFrame) -> DataFrame:
    """Drop edges whose two ends are equal."""
    return edges.where(F.col("a") != F.col("b"))


def bidirectional_edges(edges: DataFrame) -> DataFrame:
    """Each non-loop edge in both directions (G1). Duplicates are kept; every consumer
    aggregates them away map-side."""
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("a"), F.col("b").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("a").alias("b")),
        )
    ).alias("e")
    return drop_self_loops(edges).select(both).select("e.a", "e.b")


# --- A1-A3: per-node aggregates --------------------------------------------------------


def neighbors_by_node(bi: DataFrame) -> DataFrame:
    """Per node: number of distinct neighbours and the smallest and largest one (A1).

    The aggregate form of grouping a node's edges; no neighbour list is built."""
    return bi.groupBy("a").agg(
        F.count_distinct("b").alias("neighbors"),
        F.min("b").alias("min_b"),
        F.max("b").alias("max_b"),
    )


def node_stats(bi: DataFrame) -> DataFrame:
    """Per node ``a``: the smallest member ``m`` of {a} ∪ neighbours (A2) and the
    progress flag (A3): the set has more than two members and ``a`` is not its
    smallest. With self-loops removed, "more than two members" is "the smallest and
    the largest neighbour differ", so no distinct count is needed."""
    agg = bi.groupBy("a").agg(F.min("b").alias("min_b"), F.max("b").alias("max_b"))
    return agg.select(
        "a",
        F.least(F.col("a"), F.col("min_b")).alias("m"),
        ((F.col("a") > F.col("min_b")) & (F.col("min_b") != F.col("max_b"))).alias("progress"),
    )


def relink_to_smallest(bi: DataFrame, stats: DataFrame) -> DataFrame:
    """Per node: ``(m, x, progress)`` for every member x ≠ m of {node} ∪ neighbours.

    Rows per node, before any distinct; column ``node`` says which node emitted it."""
    nbrs = bi.join(stats, "a").select(
        F.col("a").alias("node"), "m", F.col("b").alias("x"), "progress"
    )
    own = stats.select(F.col("a").alias("node"), "m", F.col("a").alias("x"), "progress")
    return nbrs.unionByName(own).where(F.col("x") != F.col("m"))


def distinct_flagged_edges(relinked: DataFrame) -> DataFrame:
    """Distinct ``(a=m, b=x, progress)`` triples (A4)."""
    return relinked.select(F.col("m").alias("a"), F.col("x").alias("b"), "progress").distinct()


def distinct_edges(flagged: DataFrame) -> DataFrame:
    """Distinct ``(a, b)`` pairs (A5)."""
    return flagged.select("a", "b").distinct()


def progress_edges(flagged: DataFrame) -> DataFrame:
    """Edges flagged as progress, flag dropped."""
    return flagged.where(F.col("progress")).select("a", "b")


def equiv_round(edges: DataFrame, stage: Stage | None = None, name: str = "node_stats", rows: int | None = 0) -> DataFrame:
    """One relinking round (I1). With ``stage`` the per-node facts are written first, so
    that AQE can split a hub in the join with them. ``rows``: the number of edges, for
    :func:`shuffled` (None: not known, many).

    Returns ``(a, b, progress)``: the new edge set, one row per distinct edge, with
    ``progress`` true when any emission of that edge was a progress emission. So
    ``select(a, b)`` is the new edge set (A5) and ``where(progress)`` the progress
    edges (P8); A4 and A5 fold into one aggregate, one shuffle."""
    bi = bidirectional_edges(edges)
    stats = node_stats(bi)
    stats = stats if stage is None else stage(stats, name)
    relinked = relink_to_smallest(bi, shuffled(stats, 2 * rows if rows is not None else BROADCAST_ROWS + 1))
    return relinked.groupBy(F.col("m").alias("a"), F.col("x").alias("b")).agg(
        F.max("progress").alias("progress")
    )


def progress_count(flagged: DataFrame) -> int:
    """Number of progress edges of a round."""
    return flagged.where(F.col("progress")).count()


# --- I2, I3: fixpoints ---------------------------------------------------------------


def _observed_sum(df: DataFrame, name: str, flag) -> tuple[DataFrame, Observation]:
    """Attach a counter of rows where ``flag`` holds; it is filled by whatever job
    runs the plan (the stage write), so no extra pass is needed. Retried tasks can
    only over-count, and callers test the counter for zero. Names are made unique,
    so concurrent or repeated fixpoints never read each other's counters."""
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.sum(F.when(flag, 1).otherwise(0)).alias("n"), F.count(F.lit(1)).alias("rows")), obs


def _count(obs: Observation, staged: DataFrame, what: str = "n") -> int:
    """The counter's value (``rows``: all rows). When the optimizer proved the input empty it
    drops the observed node and no metrics arrive; that is confirmed on the staged result."""
    try:
        return int(obs.get.get(what) or 0)
    except Exception:
        if staged.isEmpty():
            return 0
        raise


def equiv_fixpoint(
    edges: DataFrame,
    stage: Stage | None = None,
    max_rounds: int = MAX_ROUNDS,
    trace: list | None = None,
) -> tuple[DataFrame, int]:
    """Repeat :func:`equiv_round` until a round has no progress edge.

    Returns the last round's edges ``(a=smallest, b=id)`` and the number of rounds.
    ``stage(df, name)`` persists each round (default: a Parquet table in the shared
    checkpoint folder); the progress edges are counted while the round is written
    (A9), so each round is one job. With ``trace`` every round's table is kept
    (the default stage deletes rounds that are two rounds old)."""
    spark = edges.sparkSession
    side = default_stage(spark)
    if stage is None:
        stage = parquet_stage(workspace(spark, "rounds")) if trace is not None else default_stage(spark)
    current, rows = edges.select("a", "b"), None
    for i in range(1, max_rounds + 1):
        split = side if rows is None or rows > SPLIT_ROWS else None
        flagged, progress = _observed_sum(equiv_round(current, split, f"stats_{i}", rows), f"equiv_round_{i}", F.col("progress"))
        flagged = stage(flagged, f"equiv_round_{i}")
        rows = _count(progress, flagged, "rows")
        if trace is not None:
            trace.append(flagged)
        if _count(progress, flagged) == 0:
            return flagged.select("a", "b"), i
        current = flagged.select("a", "b")
    raise FixpointError(f"equiv_fixpoint did not converge in {max_rounds} rounds")


def _large_star(oriented: DataFrame, name: str, stage: Stage | None, rows: int = 0) -> tuple[DataFrame, Observation]:
    """Large-star: every node links its larger neighbours to the smallest member of
    its closed neighbourhood. Output oriented ``a > b``. It is not made distinct:
    each input edge is relinked exactly once (from its smaller end), so the output
    has as many rows as the input, and small-star's ``min`` and final ``distinct``
    absorb the duplicates; this saves a shuffle per round. The counter is the number
    of links to a node other than the emitting one."""
    bi = bidirectional_edges(oriented)
    mins = bi.groupBy("a").agg(F.min("b").alias("min_b")).select(
        "a", F.least(F.col("a"), F.col("min_b")).alias("m")
    )
    mins = mins if stage is None else stage(mins, f"{name}_mins")
    emitted = bi.where(F.col("b") > F.col("a")).join(shuffled(mins, 2 * rows), "a")
    emitted, obs = _observed_sum(emitted, name, F.col("m") != F.col("a"))
    return emitted.select(F.col("b").alias("a"), F.col("m").alias("b")), obs


def _small_star(oriented: DataFrame, name: str, stage: Stage | None, rows: int = 0) -> tuple[DataFrame, Observation]:
    """Small-star: every node links itself and its smaller neighbours to the smallest
    of them. Input oriented ``a > b`` (duplicates allowed), output oriented and
    distinct. One join with the per-node minimum yields both emitted edges, so the
    input is read twice (aggregate, join). The counter is the number of moved edges
    (a node with more than one smaller neighbour)."""
    mins = oriented.groupBy("a").agg(F.min("b").alias("m"))
    mins = mins if stage is None else stage(mins, f"{name}_mins")
    joined, obs = _observed_sum(oriented.join(shuffled(mins, rows), "a"), name, F.col("b") != F.col("m"))
    both = F.explode(
        F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        )
    ).alias("e")
    out = joined.select(both).select("e.a", "e.b").where(F.col("a") != F.col("b"))
    return out.distinct(), obs


def star_fixpoint(
    edges: DataFrame,
    stage: Stage | None = None,
    max_rounds: int = MAX_ROUNDS,
    trace: list | None = None,
) -> tuple[DataFrame, int]:
    """Alternate large-star and small-star until a round changes nothing.

    A round with no relink in large-star and no move in small-star proves the
    graph is a star forest around each component's smallest id: then every node
    with a larger neighbour has no smaller one, and every other node has exactly
    one smaller neighbour. Each round is written as a table, and so is the large-star
    step, which small-star reads twice, and the minima of either step where the round has more
    than ``SPLIT_ROWS`` edges. The counters are filled by those writes. Returns star edges ``(a=id, b=smallest)`` and the number of
    rounds. With ``trace`` every round's table is kept and appended to it."""
    spark = edges.sparkSession
    side = parquet_stage(workspace(spark, "stars"), keep_last=3)
    if stage is None:
        stage = parquet_stage(workspace(spark, "rounds")) if trace is not None else default_stage(spark)
    oriented = drop_self_loops(edges).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    oriented, first = _observed_sum(oriented.distinct(), "star_0", F.lit(True))
    oriented = stage(oriented, "star_0")
    rows = _count(first, oriented, "rows")
    for i in range(1, max_rounds + 1):
        large, relinked = _large_star(oriented, f"large_star_{i}", side if rows > SPLIT_ROWS else None, rows)
        large = side(large, f"large_{i}")
        rows = _count(relinked, large, "rows")
        small, moved = _small_star(large, f"small_star_{i}", side if rows > SPLIT_ROWS else None, rows)
        oriented = stage(small, f"star_{i}")
        if trace is not None:
            trace.append(oriented)
        if _count(relinked, large) == 0 and _count(moved, oriented) == 0:
            return oriented, i
    raise FixpointError(f"star_fixpoint did not converge in {max_rounds} rounds")


def swap_pair(edges: DataFrame) -> DataFrame:
    """``(a=canonical, b=id)`` → ``(id, canonical_id)``."""
    return edges.select(F.col("b").alias("id"), F.col("a").alias("canonical_id"))


def person_codes(edges: DataFrame, stage: Stage) -> DataFrame:
    """``(p PERSON, code bigint)`` for every person of ``edges``, with codes in person
    order.

    The distinct persons are sorted once (range partitioning); after the sort,
    ``monotonically_increasing_id`` (partition index in the high bits, row index in
    the low ones) grows strictly with the sort order, so ``min`` on codes picks the
    same person as ``min`` on the structs. The table is staged, so every later use
    (and any recomputation after a lost executor) sees the same codes."""
    persons = edges.select(F.col("a").alias("p")).unionByName(edges.select(F.col("b").alias("p"))).distinct()
    codes = persons.orderBy("p").select("p", F.monotonically_increasing_id().alias("code"))
    return stage(codes, "person_codes")


def encode_edges(edges: DataFrame, codes: DataFrame) -> DataFrame:
    """Edges of persons → edges of their codes."""
    codes = shuffled(codes)
    ca = codes.select(F.col("p").alias("_pa"), F.col("code").alias("_ca"))
    cb = codes.select(F.col("p").alias("_pb"), F.col("code").alias("_cb"))
    return (
        edges.join(ca, F.col("a") == F.col("_pa"))
        .join(cb, F.col("b") == F.col("_pb"))
        .select(F.col("_ca").alias("a"), F.col("_cb").alias("b"))
    )


def decode_map(coded: DataFrame, codes: DataFrame) -> DataFrame:
    """``(id code, canonical code)`` → ``(id PERSON, canonical_id PERSON)``."""
    codes = shuffled(codes)
    ci = codes.select(F.col("code").alias("_ci"), F.col("p").alias("id"))
    cc = codes.select(F.col("code").alias("_cc"), F.col("p").alias("canonical_id"))
    return (
        coded.join(ci, F.col("cid") == F.col("_ci"))
        .join(cc, F.col("ccanon") == F.col("_cc"))
        .select("id", "canonical_id")
    )


def canonical_ids(
    edges: DataFrame,
    method: str = "star",
    stage: Stage | None = None,
    max_rounds: int = MAX_ROUNDS,
    encode: bool = True,
) -> DataFrame:
    """``(id, canonical_id)`` for every id that is not the smallest of its component
    (I3). Ids seen only in self-loops map to themselves and get no row.

    With ``encode`` (default) the fixpoint runs on order-preserving ``bigint`` codes of
    the persons (:func:`person_codes`), whatever the size: its ``min``/``max`` aggregates
    are then hash aggregates on fixed-width values instead of sort aggregates on structs,
    and every shuffle carries 8-byte keys. The map is decoded at the end by two joins."""
    if method not in ("star", "relink"):
        raise ValueError(f"unknown method {method!r}")
    spark = edges.sparkSession
    # rounds may be deleted once superseded; the codes and the map are kept
    keep = stage or parquet_stage(workspace(spark, "canonical"))
    stage = stage or default_stage(spark)
    codes = None
    work = edges.select("a", "b")
    if encode:
        work = drop_self_loops(work)
        codes = person_codes(work, keep)
        work = encode_edges(work, codes)
    if method == "relink":
        final, _ = equiv_fixpoint(work, stage=stage, max_rounds=max_rounds)
        pairs = swap_pair(final)
    else:
        stars, _ = star_fixpoint(work, stage=stage, max_rounds=max_rounds)
        pairs = stars.select(F.col("a").alias("id"), F.col("b").alias("canonical_id"))
    if codes is None:
        return pairs
    coded = pairs.select(F.col("id").alias("cid"), F.col("canonical_id").alias("ccanon"))
    return keep(decode_map(coded, codes), "canonical_ids")


# --- J1, P15, J2 ---------------------------------------------------------------------


def person_left_join(views: DataFrame, canon: DataFrame) -> DataFrame:
    """Left outer join of page-view facts with ``(id, canonical_id)`` on the viewing
    person (J1); unmatched views keep ``canonical_id`` null. ``id`` is unique in a
    canonical map, so no view is multiplied. AQE picks broadcast only when the
    map's measured size is under the broadcast threshold, else sort-merge with
    skew splitting of hot persons."""
    c = canon.select(F.col("id").alias("_cid"), F.col("canonical_id").alias("_canonical"))
    return views.join(c, F.col("dataunit.page_view.person") == F.col("_cid"), "left")


def resolve_person(joined: DataFrame) -> DataFrame:
    """Use the canonical id when the lookup hit, else the own id."""
    person = F.coalesce(F.col("_canonical"), F.col("dataunit.page_view.person"))
    return joined.withColumn(
        "dataunit", set_nested(F.col("dataunit"), "page_view", "person", person)
    ).drop("_cid", "_canonical")


def normalize_user_ids(views: DataFrame, canon: DataFrame) -> DataFrame:
    """Page views with every person replaced by its canonical id (J2); page views only.
    Partition columns, when present, are kept."""
    v = only_unit(views, S.UNIT_PAGE_VIEW)
    v = v.select("pedigree", "dataunit", *[c for c in ("unit_id", "property_id") if c in v.columns])
    return resolve_person(person_left_join(v, canon))
