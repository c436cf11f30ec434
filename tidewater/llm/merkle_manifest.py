"""Merkle manifest of a dataset: a content-addressed DAG and descents through it.

Every row is a leaf, the SHA-256 of its columns. The leaves of a group, in the order of their ids,
are the bottom of the group's tree: runs of ``FAN_OUT`` neighbours become the SHA-256 of their
digests until one node is left. The groups' roots, in the order of the groups, are the leaves of one
more tree above them. What is stored are records, digest to the children's digests, by level.

A proof is found by descent: requests start at the root, look their node's record up by its digest,
go on to the child that the next digit of the leaf's rank names, and put the digests of the other
children down as a segment of the path; the reversed path is the proof. All leaves below a node ask
for the same record, so one request stands for them until their digits part: a level has as many
requests as nodes that are asked for, and no digest is looked up by more than its own node.

A group may hold any share of all rows: ranks come from a range partitioning of all leaves, and all
later joins and groupings go by node.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import saved

FAN_OUT = 3
TOP = -1  # the tree over the groups' roots
_LEVELS_AT_ONCE = 4


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256, in hex, of the columns: ``-`` for null, else byte length, ``:`` and the value."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]), 256)


def node_digest(children: Column) -> Column:
    return F.sha2(F.array_join(children, ""), 256)


def numbered(df: DataFrame, order: Sequence[str], name: str, label: str) -> DataFrame:
    """``df`` with the rank of each row by ``order`` (nulls first) from 0, and the task that held
    the row as ``_part``. Rows that tie get any of their ranks."""
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").withColumn("_at", F.monotonically_increasing_id()).drop("_tie")
    placed = saved(placed.withColumn("_part", F.shiftright("_at", 33).cast("int")), label)
    counts = sorted(placed.groupBy("_part").count().collect())  # a row for each task
    before, starts = 0, []
    for part, n in counts:
        starts.append((part, before - (part << 33)))
        before += n
    shift = df.sparkSession.createDataFrame(starts, "_part int, _shift long")
    return placed.join(F.broadcast(shift), "_part").withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_shift")


@dataclass
class Manifest:
    """Root digest (None without rows); ``leaves`` (sid, idx, id, grp, leaf and the columns kept),
    ``groups`` (sid, grp, subroot, height), and the records of each level by tree kind."""

    root: str | None
    leaves: DataFrame
    groups: DataFrame
    levels: list[DataFrame] = field(default_factory=list)
    top_levels: list[DataFrame] = field(default_factory=list)


def _levels(nodes: DataFrame, most: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Records of each level above ``nodes`` (sid, idx, n nodes in the row's tree, digest), and
    the last node (sid, digest, height) of every tree."""
    ended, records, height = [], [], 0
    while True:
        ended.append(nodes.where("n = 1").select("sid", "digest", F.lit(height).alias("height")))
        if most <= 1:
            break
        run = F.floor(F.col("idx") / FAN_OUT).cast("long")
        children = F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"])  # FAN_OUT at most
        parents = nodes.where("n > 1").groupBy("sid", run.alias("idx")).agg(F.ceil(F.first("n") / FAN_OUT).cast("long").alias("n"), children.alias("children"))
        nodes = saved(parents.withColumn("digest", node_digest(F.col("children"))), f"{label}-{height + 1}")
        records.append(nodes)
        most, height = -(-most // FAN_OUT), height + 1
    last = ended[0]
    for more in ended[1:]:
        last = last.unionByName(more)
    return records, last


def build_manifest(rows: DataFrame, leaf_cols: Sequence[str], id_col: str, group_col: str, keep: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``rows``; ``keep`` adds named columns to the leaves.

    Null ids and groups come first; rows of one group and id are ordered by their leaves, so a
    repeated row is a leaf of its own with the same digest. Empty texts count as empty, not as
    null. Other columns are ignored whatever their names. Without rows the root is None.
    """
    leaves = rows.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in leaf_cols]).alias("leaf"),
                         *[c.alias(name) for name, c in (keep or {}).items()])
    placed = numbered(leaves, ["grp", "id", "leaf"], "place", "leaves")
    # A group's leaves lie in many tasks' ranges; joins go by group and task, so none is large.
    spans = saved(placed.groupBy("grp", "_part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), "spans")
    totals = spans.groupBy("grp").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    groups = numbered(totals, ["first"], "sid", "groups").drop("_part")
    where = spans.select("grp", "_part").join(groups, spans["grp"].eqNullSafe(groups["grp"])).select(spans["grp"].alias("g"), F.col("_part").alias("p"), "sid", "first", "n")
    inside = placed.join(where, placed["grp"].eqNullSafe(where["g"]) & (placed["_part"] == where["p"]))
    inside = saved(inside.select("sid", (F.col("place") - F.col("first")).alias("idx"), "n", "id", "grp", "leaf", *(keep or {})), "ranked")
    most, count = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    levels, subroots = _levels(inside.select("sid", "idx", "n", F.col("leaf").alias("digest")), most or 0, "level")
    found = saved(groups.join(subroots, "sid").select("sid", "grp", F.col("digest").alias("subroot"), "height"), "subroots")
    over = found.select(F.lit(TOP).cast("long").alias("sid"), F.col("sid").alias("idx"), F.lit(count).alias("n"), F.col("subroot").alias("digest"))
    top_levels, root = _levels(over, count, "top")
    top = root.first()
    return Manifest(top["digest"] if top else None, inside.drop("n"), found, levels, top_levels)


PATH = "array<struct<left:string,right:string>>"


def _look_up(requests: DataFrame, level: DataFrame) -> DataFrame:
    """``requests`` with their nodes' children, by digest."""
    store = level.groupBy("digest").agg(F.first("children").alias("children"))  # equal nodes are one record
    return requests.join(store, "digest")


def _others(children: Column, digit: Column) -> Column:
    """The segment that the child of that number adds to the path: what stands on either side."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
                    F.array_join(F.slice(children, digit + 2, F.lit(FAN_OUT)), "").alias("right"))


def _down(requests: DataFrame, level: DataFrame, asked: DataFrame | None) -> DataFrame:
    """The requests one level lower."""
    met = _look_up(requests, level)
    others = [c for c in requests.columns if c not in ("digest", "idx", "path")]
    met = met.select(*others, "idx", "path", "children", F.posexplode("children").alias("digit", "child"))
    lower = met.select(*others, (F.col("idx") * FAN_OUT + F.col("digit")).alias("idx"), F.col("child").alias("digest"),
                       F.concat("path", F.array(_others(F.col("children"), F.col("digit")))).alias("path"))
    return lower.join(asked, ["sid", "idx"], "left_semi") if asked is not None else lower


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """The leaves with ``subroot`` and ``path``: for each node from the leaf up, what stands left and
    right of it in its run. Of all leaves, or of those whose ``id`` is in ``wanted``, a frame of one
    column; descents then only open the records above them."""
    spark, leaves = manifest.leaves.sparkSession, manifest.leaves
    if manifest.root is None:
        return leaves.withColumn("subroot", F.lit(None).cast("string")).withColumn("path", F.lit(None).cast(PATH)).drop("sid", "idx")
    if wanted is not None:
        leaves = saved(leaves.join(wanted.toDF("id").distinct(), "id", "left_semi").select(leaves.columns), "wanted")

    def asked(level: int, top: bool) -> DataFrame | None:
        if wanted is None:
            return None
        place = F.col("sid") if top else F.col("idx")
        tree = F.lit(TOP).cast("long") if top else F.col("sid")
        return leaves.select(tree.alias("sid"), F.floor(place / FAN_OUT**level).cast("long").alias("idx")).distinct()

    requests = spark.createDataFrame([(TOP, 0, manifest.root)], "sid long, idx long, digest string").withColumn("path", F.array().cast(PATH))
    for at in range(len(manifest.top_levels), 0, -1):
        requests = _down(requests, manifest.top_levels[at - 1], asked(at - 1, True))
        if at % _LEVELS_AT_ONCE == 1:
            requests = saved(requests, "requests")
    entering = requests.select(F.col("idx").alias("sid"), F.lit(0).cast("long").alias("idx"), "digest", F.col("digest").alias("subroot"), "path") \
        .join(manifest.groups.select("sid", "height"), "sid")
    entering = saved(entering, "entering")
    inside = entering.where(F.lit(False)).drop("height")
    for at in range(len(manifest.levels), 1, -1):
        inside = _down(inside.unionByName(entering.where(F.col("height") == at).drop("height")), manifest.levels[at - 1], asked(at - 1, False))
        if at > 2 and at % _LEVELS_AT_ONCE == 0:
            inside = saved(inside, "requests")
    # The last step goes to the leaves themselves, a run of them for each request.
    inside = inside.unionByName(entering.where("height = 1").drop("height"))
    runs = _look_up(inside, manifest.levels[0]) if manifest.levels else inside.withColumn("children", F.array("digest"))
    alone = entering.where("height = 0").withColumn("children", F.lit(None).cast("array<string>"))
    columns = [F.col("sid").alias("_sid"), F.col("idx").alias("_run"), "subroot", "path", "children"]
    runs = runs.select(columns).unionByName(alone.select(columns))
    digit = (F.col("idx") % FAN_OUT).cast("int")
    whole = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat("path", F.array(_others(F.col("children"), digit))))
    met = leaves.join(runs, (F.col("sid") == F.col("_sid")) & (F.floor(F.col("idx") / FAN_OUT).cast("long") == F.col("_run")))
    return met.select(*[c for c in leaves.columns if c not in ("sid", "idx")], "subroot", F.reverse(whole).alias("path"))


def proof_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
