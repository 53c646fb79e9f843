"""Merkle manifest of a dataset: a tree per source over the hashes of its rows, a tree of the sources over those.

Rows become leaves where they are read; only hashes are shuffled.  Leaves are numbered inside their source from range
partitions and partition counts, so a source with a third of all rows is numbered by many tasks.  Every level is a
sibling-shift self-join: a node in slot zero of its run computes the indices of its siblings (its own index, shifted by
each slot offset), an equijoin fetches their hashes, and the run's hash becomes the parent.  All sources climb one level
at a time, so the jobs grow with the height of the tallest tree, not with the number of sources.  On the way down every
node gets its parent's run and the runs above, which are its proof."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revsift.llm import common as C
from revsift.session import cut_lineage

FANOUT = 16
DIGEST = 64  # hex characters of a hash


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of a string's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(columns) -> Column:
    """Hash of a row: per column ``-`` if null, else UTF-8 byte count, ``:`` and value (integers in decimal)."""
    parts = [c.cast("string") for c in columns]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]))


def tampered_text(text: Column, id_text: Column) -> Column:
    """The text with A-Z in lower case where 5 divides the crc32 of the id; other rows and nulls stay."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.coalesce(F.crc32(id_text.cast("binary")) % 5 == 0, F.lit(False))
    return F.when(hit, F.translate(text, upper, lower)).otherwise(text)


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds ``idx``, the row's number from 0 inside its group, nulls of ``order`` first, and ``n``, the group's rows.

    The rows are dealt into ranges of (group, order) and sorted inside each; a row's place in its partition less the
    place where its group begins there, plus what earlier partitions hold of the group, is its number.  Rows that
    are equal in all columns are parted by where they were read, so copies don't pile up in one range."""
    keys = [F.asc(group), *map(F.asc_nulls_first, order), F.asc("_read")]
    dealt = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()   # the partition's number above, the place in the partition in the low 33 bits
    dealt = cut_lineage(dealt.drop("_read").withColumn("_p", F.shiftright(at, 33)).withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1))))
    # a row per partition and group in it: at most partitions + groups
    parts = dealt.groupBy("_p", F.col(group).alias("_g")).agg(F.count("_at").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("_g")
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_p").alias("_q"), "_g", F.sum("_n").over(whole).alias("n"),
                         (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    found = dealt.join(parts, (F.col("_p") == F.col("_q")) & (F.col(group) == F.col("_g")))
    return found.withColumn("idx", F.col("_at") + F.col("_shift")).drop("_p", "_q", "_g", "_at", "_shift")


def climb(nodes: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], list[DataFrame]]:
    """From the lowest nodes (grp, idx, n, hash) up: the parents of each level (grp, idx, n, run, hash), where run is
    the children's hashes in order, and the finished nodes of each level, those that are alone (n is 1), lowest first."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    nodes = nodes.withColumn("run", F.lit(None).cast("string"))
    levels, tops = [], [nodes.where("n = 1")]
    while most > 1:
        left = nodes.where("n > 1")
        # slot zero computes its siblings' indices by the slot offsets, as far as the group goes
        head = (left.where(F.col("idx") % fanout == 0)
                .select("grp", "n", F.col("idx").alias("head"), F.explode(F.array(*map(F.lit, range(fanout)))).alias("slot"))
                .withColumn("sibling", F.col("head") + F.col("slot")).where("sibling < n"))
        hashes = left.select(F.col("grp").alias("_g"), F.col("idx").alias("_i"), "hash")
        runs = (head.join(hashes, (F.col("grp") == F.col("_g")) & (F.col("sibling") == F.col("_i")))
                .groupBy("grp", "n", "head").agg(F.sort_array(F.collect_list(F.struct("slot", "hash"))).alias("r")))
        nodes = cut_lineage(runs.select("grp", F.expr(f"head div {fanout}").alias("idx"), F.ceil(F.col("n") / fanout).alias("n"),
                                        F.array_join(F.col("r.hash"), "").alias("run"))
                            .withColumn("hash", digest(F.col("run"))))
        levels.append(nodes)
        tops.append(nodes.where("n = 1"))
        most = -(-most // fanout)
    return levels, tops


def with_path(nodes: DataFrame, parents: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Nodes that have a parent, with ``path``: the parent's run and the node's slot in it, then the parent's path; and
    the parent's ``subroot``.  ``parents``: grp, idx, run, path, subroot."""
    up = parents.select(F.col("grp").alias("_g"), F.col("idx").alias("_i"), F.col("run").alias("_run"), F.col("path").alias("_path"), "subroot")
    step = F.struct(F.col("_run").alias("run"), (F.col("idx") % fanout).cast("int").alias("slot"))
    return (nodes.join(up, (F.col("grp") == F.col("_g")) & (F.expr(f"idx div {fanout}") == F.col("_i")))
            .withColumn("path", F.concat(F.array(step), F.col("_path"))).drop("_g", "_i", "_run", "_path"))


def with_paths(nodes: DataFrame, levels: list[DataFrame], tops: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest nodes with ``path`` and ``subroot``.  ``above``: grp, path, subroot of each group's finished node."""
    at = F.col("grp") == F.col("_g")
    above = above.withColumnRenamed("grp", "_g")
    parents = None
    for level, top in zip(reversed(levels), reversed(tops)):
        found = top.join(above, at).select("grp", "idx", "run", "path", "subroot")
        if parents is not None:
            inner = with_path(level.where("n > 1"), parents).select("grp", "idx", "run", "path", "subroot")
            found = found.unionByName(inner)
        parents = cut_lineage(found)
    alone = nodes.where("n = 1").join(above, at).drop("_g")
    return alone if parents is None else alone.unionByName(with_path(nodes.where("n > 1"), parents))


def left_of(step: Column) -> Column:
    return F.substring(step["run"], F.lit(1), step["slot"] * DIGEST)


def right_of(step: Column) -> Column:
    return F.substring(step["run"], step["slot"] * DIGEST + (DIGEST + 1), F.length(step["run"]))


def merkle_manifest(df: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    leaf_cols=("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf hashes ``leaf_cols``; leaves of a source ascend by id (null ids first, repeated ids by leaf), runs of FANOUT
    become their hash until one node, the subroot, is left; the subroots, ordered by source (null first, bytewise),
    likewise give the root.  proof_sha256 hashes the siblings on the way up, left to right.  folded_root is recomputed
    from the row's tampered leaf (:func:`tampered_text`) and the siblings, and is verified if it equals the root.
    Null values have a hash of their own kind, empty texts differ from nulls, equal rows are leaves each; other columns
    are not read; an empty table gives an empty result."""
    spark = C.prepare(df.sparkSession)
    kept = [F.col(f"`{c}`") for c in leaf_cols]
    changed = [tampered_text(F.col(f"`{c}`").cast("string"), F.col(f"`{id_col}`").cast("string")) if c == text_col else F.col(f"`{c}`")
               for c in leaf_cols]
    # "" is the null source: it comes first, every other name follows its "="
    grp = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit(""))
    rows = cut_lineage(df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), grp.alias("grp"), leaf_hash(kept).alias("hash"),
                                 leaf_hash(changed).alias("tampered")))
    leaves = cut_lineage(numbered(rows, "grp", "doc_id", "hash"))
    levels, tops = climb(leaves.select("grp", "idx", "n", "hash"))
    subroots = tops[0].select("grp", "hash")
    for top in tops[1:]:
        subroots = subroots.unionByName(top.select("grp", "hash"))
    subroots = cut_lineage(subroots.withColumnRenamed("grp", "source_grp").withColumn("grp", F.lit("all")))
    stems = cut_lineage(numbered(subroots, "grp", "source_grp"))
    root_levels, root_tops = climb(stems.select("grp", "idx", "n", "hash"))
    root = next((r[0] for r in (t.select("hash").first() for t in reversed(root_tops)) if r), None)
    nothing = spark.createDataFrame([("all", [], "")], "grp string, path array<struct<run: string, slot: int>>, subroot string")
    above = with_paths(stems, root_levels, root_tops, nothing)
    above = cut_lineage(above.select(F.col("source_grp").alias("grp"), "path", F.col("hash").alias("subroot")))
    found = with_paths(leaves, levels, tops, above)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(left_of(s), right_of(s))), "")
    folded = F.aggregate("path", F.col("tampered"), lambda h, s: digest(F.concat(left_of(s), h, right_of(s))))
    return (found.select("doc_id", F.col("hash").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"),
                         digest(siblings).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
