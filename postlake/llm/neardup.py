"""MinHash near-dedup with an LSH forest, confirmed on full shingle sets.

Documents are sets of distinct 5-word shingles (A-Z lower-cased; fewer words:
the whole sequence).  Two are linked if their Jaccard similarity is at least
75 %; a component is what links reach.

1. Each text gives its set's hash, size and 64 MinHash values.  Equal sets
   collapse to one representative by a partial aggregate, so exact copies cost
   a row each and no comparison.
2. The forest: ``TREES`` orders of the signature.  An order starts at its own
   three values and goes on through five more; all rows are range-sorted by
   (order, values).  A row's candidates are its ``NEIGHBOURS`` nearest rows on
   either side that share a prefix of three values at least.  In a dense
   region the nearest rows are those of the longest common prefix, so the depth
   adapts to the region.  Pairs whose 48 one-byte fingerprints agree in fewer
   than ``MIN_AGREE`` places are dropped (a link is missed by that with
   probability below 1e-6).  Rows of a chain of close rows are tied
   to the chain's smallest node.  Rows at the ends of two ranges meet in a second
   small pass.
3. Candidate pairs only say which documents must be looked at together: their
   connected components (contraction with pointer jumping, on id pairs) are
   the candidate groups.  Texts of documents that have a candidate move
   once, to their group's task, where all members are compared on full sets.
   This makes the cut at ``NEIGHBOURS`` harmless inside a group.
4. Groups beyond ``GROUP_DOCS`` documents or ``GROUP_SHINGLES`` shingles are
   split into blocks.  Each block is compared within and against the group's
   most central members; then every document outside the group's largest
   component so far is compared with every block.  Each pair of documents in
   different components is thereby compared on full sets, so no link between
   components is lost; only one edge per document and component is emitted.

Expected recall of a pair at similarity 0.75: it misses one order with
probability 1 - 0.75 ** 3, all ``TREES`` = 20 with 2e-5.

Cases: null and wordless texts have no shingles and stand alone.  Rows that
repeat a doc_id are one document with all its texts' links; a null doc_id is
never linked, its component is null and it is not kept.  An empty table gives
an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import map_rows, slices, written

SHINGLE = 5
PERCENT = 75
VALUES = 64
TREES, SHARED, DEPTH = 20, 3, 8
NEIGHBOURS = 8
FINGERPRINT, MIN_AGREE = 48, 22
GROUP_DOCS, GROUP_SHINGLES = 1_000, 2_000_000
HUBS = 16
#: Group members whose ids are broadcast to pick their texts (some 50 bytes each).
BROADCAST_ROWS = 250_000

_ODD = np.random.default_rng(2024).integers(1, 1 << 63, VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(n, size)
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _MIX + w[i:n - k + 1 + i]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(h ^ (h >> np.uint64(32)))


def signature(s: np.ndarray) -> np.ndarray:
    """``VALUES`` MinHash values of 32 bits."""
    out = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 4096):
        out = np.minimum(out, (s[i:i + 4096, None] * _ODD).min(0))
    return (out >> np.uint64(32)).astype(np.uint32)


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_hash, sig) per row of ``docs``."""
    def run(rows):
        for doc_id, text_hash, text in rows:
            s = shingles(text)
            yield doc_id, text_hash, len(s), xxhash.xxh3_128_digest(s.tobytes()), signature(s).tobytes()
    return map_rows(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text"), run,
                    "doc_id long, text_hash long, n_shingles long, set_hash binary, sig binary")


def _binary(a: np.ndarray) -> pa.Array:
    """Rows of a byte matrix as a binary column."""
    n, k = a.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n * k + 1, k, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(a).tobytes())])


def _matrix(col: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype).reshape(len(col), width)


def forest_rows(reps: DataFrame) -> DataFrame:
    """(tree, path, node, mark): each representative in each order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2_000):
                part = batch.slice(i, 2_000)
                sig = _matrix(part["sig"], np.uint32, VALUES)
                mark = _binary(sig[:, :FINGERPRINT].astype(np.uint8))
                for t in range(TREES):
                    path = np.ascontiguousarray(sig[:, (SHARED * t + np.arange(DEPTH)) % VALUES], ">u4").view(np.uint8)
                    yield pa.record_batch({"tree": pa.array(np.full(len(sig), t, np.int32)), "path": _binary(path), "node": part["node"], "mark": mark})
    return reps.select("node", "sig").mapInArrow(run, "tree int, path binary, node long, mark binary")


def _near(tree, path, node, mark, first: int) -> Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of nodes within reach, given the sorted rows; rows before
    ``first`` were seen with the rows before them.

    Rows that follow each other closely form chains.  A chain's rows are tied
    to its smallest node, which is mostly the same in all orders, and farther
    pairs only count between chains; nothing else would connect more."""
    n, chain = len(node), None
    for k in range(1, min(NEIGHBOURS, n - 1) + 1):
        at = np.arange(k, n)
        if chain is not None:
            at = at[(at >= first) & (chain[at] != chain[at - k])]
        at = at[(tree[at] == tree[at - k]) & (path[at, :SHARED] == path[at - k, :SHARED]).all(1)]
        agree = (mark[at] == mark[at - k]).sum(1)
        at, agree = at[agree >= MIN_AGREE], agree[agree >= MIN_AGREE]
        if chain is not None:
            ok = node[at] != node[at - k]
            yield node[at[ok]], node[at[ok] - k], agree[ok]
            continue
        begins = np.ones(n, bool)
        begins[at] = False
        starts = np.flatnonzero(begins)
        chain = np.cumsum(begins) - 1
        low, grown = np.minimum.reduceat(node, starts)[chain], np.maximum.reduceat(np.arange(n), starts)[chain] >= first
        score = np.zeros(n, np.int64)
        score[at] = agree
        score[at - 1] = np.maximum(score[at - 1], agree)
        ok = grown & (node != low)
        yield node[ok], low[ok], score[ok]


def _neighbour_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of one sorted range, and its end rows for the range beside it.

    Pairs have ``edge`` null; end rows carry the number of the border."""
    from pyspark import TaskContext
    p = TaskContext.get().partitionId()
    last, head = None, 0

    def ends(rows, border):
        tree, path, node, mark = rows
        return pa.record_batch({"a": pa.array(node), "b": pa.nulls(len(node), pa.int64()), "agree": pa.array(tree.astype(np.int32)),
                                "edge": pa.array(np.full(len(node), border, np.int64)), "side": pa.array(np.full(len(node), int(border == p), np.int32)),
                                "path": _binary(np.ascontiguousarray(path, ">u4").view(np.uint8)), "mark": _binary(mark)})

    for batch in batches:
        rows = (batch["tree"].to_numpy(), _matrix(batch["path"], ">u4", DEPTH).astype(np.uint32), batch["node"].to_numpy(),
                _matrix(batch["mark"], np.uint8, FINGERPRINT))
        if not batch.num_rows:
            continue
        if head < NEIGHBOURS:
            take = min(NEIGHBOURS - head, batch.num_rows)
            yield ends([x[:take] for x in rows], p - 1)
            head += take
        first = 0 if last is None else len(last[2])
        rows = rows if last is None else [np.concatenate(x) for x in zip(last, rows, strict=True)]
        for a, b, agree in _near(*rows, first):
            if len(a):
                yield _pairs(a, b, agree)
        last = [x[-NEIGHBOURS:] for x in rows]
    if last is not None:
        yield ends(last, p)


def _pairs(a, b, agree):
    n = len(a)
    return pa.record_batch({"a": pa.array(a), "b": pa.array(b), "agree": pa.array(agree.astype(np.int32)), "edge": pa.nulls(n, pa.int64()),
                            "side": pa.nulls(n, pa.int32()), "path": pa.nulls(n, pa.binary()), "mark": pa.nulls(n, pa.binary())})


_PASS = "a long, b long, agree int, edge long, side int, path binary, mark binary"


def candidate_pairs(reps: DataFrame) -> DataFrame:
    """(a, b, agree): nodes that meet in the forest, with their fingerprint agreement."""
    ranges = forest_rows(reps).repartitionByRange("tree", "path", "node").sortWithinPartitions("tree", "path", "node")
    found = written(ranges.mapInArrow(_neighbour_pass, _PASS), "forest")

    def border(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "descending"), ("agree", "ascending"), ("path", "ascending"), ("a", "ascending")])
        split = int((table["side"].to_numpy() == 1).sum())
        tree, node = table["agree"].to_numpy(), table["a"].to_numpy()
        path, mark = _matrix(table["path"].combine_chunks(), ">u4", DEPTH), _matrix(table["mark"].combine_chunks(), np.uint8, FINGERPRINT)
        got = [(a, b, g) for a, b, g in _near(tree, path, node, mark, max(1, split))]
        a, b, g = (np.concatenate([x[i] for x in got] or [np.zeros(0, np.int64)]) for i in range(3))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "agree": pa.array(g.astype(np.int32))})

    across = found.where("edge is not null").groupBy("edge").applyInArrow(border, "a long, b long, agree int")
    return found.where("edge is null").select("a", "b", "agree").unionByName(across)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp): the smallest node each node of ``edges`` (a, b) reaches.

    Rounds of contraction: every node points to its smallest neighbour or
    itself (a partial aggregate), pointers jump until they end at roots, and
    edges between roots are left for the next round, each once.  Every step is
    a written table; the driver sees row counts up to one.
    """
    def distinct(x, y, rows):
        return written(rows.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).where("x != y").distinct(), f"{name}-edges")

    left, labels = distinct(F.col("a"), F.col("b"), edges), None
    while True:
        both = left.union(left.select("y", "x"))
        to = written(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("y")).select("node", F.least("node", "y").alias("to")), name)
        while True:
            far = to.select(F.col("node").alias("_node"), F.col("to").alias("far"))
            jumped = written(to.join(far, to["to"] == far["_node"]).select("node", "to", "far"), name)
            to = jumped.select("node", F.col("far").alias("to"))
            if not jumped.where("to != far").limit(1).count():
                break
        if labels is None:
            labels = to.withColumnRenamed("to", "comp")
        else:
            step = to.withColumnRenamed("node", "_node")
            labels = written(labels.join(step, labels["comp"] == step["_node"], "left").select("node", F.coalesce("to", "comp").alias("comp")), name)
        from_x = to.select(F.col("node").alias("_x"), F.col("to").alias("tx"))
        from_y = to.select(F.col("node").alias("_y"), F.col("to").alias("ty"))
        moved = left.join(from_x, left["x"] == from_x["_x"]).select("y", "tx")
        left = distinct(F.col("tx"), F.col("ty"), moved.join(from_y, moved["y"] == from_y["_y"]))
        if not left.limit(1).count():
            return labels


def linked(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (100 * inter >= PERCENT * (a[:, None] + b[None, :] - inter)) & (inter > 0)


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Intersection sizes of sets, by products of bounded 0/1 blocks."""
    sets = left if right is None else [*left, *right]
    ids, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.flatnonzero(np.bincount(inverse) > 1)
    place = np.full(len(ids), -1)
    place[shared] = np.arange(len(shared))
    col = place[inverse]
    owner, col = owner[col >= 0], col[col >= 0]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    n = len(left)
    out = np.zeros((n, n if right is None else len(right)), np.float32)
    step = max(64, (16 << 20) // (4 * len(sets)))
    for i in range(0, len(shared), step):
        lo, hi = np.searchsorted(col, [i, i + step])
        m = np.zeros((len(sets), min(step, len(shared) - i)), np.float32)
        m[owner[lo:hi], col[lo:hi] - i] = 1
        out += m[:n] @ (m[:n] if right is None else m[n:]).T
    return out.astype(np.int64)


def smallest_reached(link: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """For each row of a link matrix the smallest node reachable."""
    label = np.array(nodes, np.int64)
    link = link | (nodes[:, None] == nodes[None, :])
    while True:
        new = np.minimum(label, np.where(link, label[None, :], np.iinfo(np.int64).max).min(1))
        if (new == label).all():
            return label
        label = new


def _by_group(fn, schema: str):
    """Runs ``fn`` on each run of equal ``unit`` in a task's sorted rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, done = None, [], []
        for batch in batches:
            for part in slices(batch):
                for row in part.to_pylist():
                    if row["unit"] != unit:
                        done += fn(held) if held else []
                        unit, held = row["unit"], []
                        if len(done) > 5_000:
                            yield pa.RecordBatch.from_pylist(done, out)
                            done = []
                    held.append((row["node"], shingles(row["text"]), row.get("role"), row.get("label")))
        done += fn(held) if held else []
        if done:
            yield pa.RecordBatch.from_pylist(done, out)
    return run


def _compare(held) -> list[dict]:
    """Labels of one unit: each member with the smallest node it reaches here."""
    nodes, sets = np.array([x[0] for x in held]), [x[1] for x in held]
    size = np.array([len(s) for s in sets])
    label = smallest_reached(linked(overlaps(sets), size, size), nodes)
    return [{"node": a, "label": b} for a, b in zip(nodes.tolist(), label.tolist(), strict=True)]


def _compare_across(held) -> list[dict]:
    """Edges between outer documents (role 0) and a block (role 1): one per
    outer document and component."""
    outer, block = ([x for x in held if x[2] == r] for r in (0, 1))
    if not outer or not block:
        return []
    a, b = (np.array([len(x[1]) for x in y]) for y in (outer, block))
    link = linked(overlaps([x[1] for x in outer], [x[1] for x in block]), a, b)
    found = {}
    for i, j in zip(*np.nonzero(link), strict=True):
        if outer[i][3] != block[j][3]:
            found[outer[i][0], block[j][3]] = block[j][0]
    return [{"a": a, "b": b} for (a, _), b in found.items()]


def _with_text(members: DataFrame, docs: DataFrame, *cols: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``members`` with their texts: each representative's text moves once.

    The members are ids only; up to ``broadcast_rows`` of them (counted) are
    broadcast and no other text moves, beyond that both sides are shuffled."""
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    few = members.limit(broadcast_rows + 1).count() <= broadcast_rows
    found = texts.join(F.broadcast(members) if few else members, (members["node"] == texts["_id"]) & (members["text_hash"] == texts["_hash"]))
    return found.dropDuplicates(["unit", "node", "text_hash"]).select("unit", "node", "text", *cols)


def _run_units(rows: DataFrame, fn, schema: str) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(_by_group(fn, schema), schema)


def links(docs: DataFrame, reps: DataFrame, pairs: DataFrame, group_docs: int = GROUP_DOCS, group_shingles: int = GROUP_SHINGLES,
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(node, label): smallest representative reached, for nodes with candidates."""
    pairs = written(pairs, "pairs")
    groups = components(pairs, "groups")
    sizes = written(groups.join(reps.select("node", "n_shingles"), "node").groupBy("comp")
                    .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
                    .withColumn("blocks", F.ceil(F.greatest(F.col("n") / group_docs, F.col("w") / group_shingles)).cast("int")), "group-sizes")
    members = written(groups.join(sizes, "comp").join(reps.select("node", "text_hash"), "node"), "members")
    small = members.where("blocks = 1").withColumn("unit", F.col("comp").cast("string"))
    done = written(_run_units(_with_text(small, docs, broadcast_rows=broadcast_rows), _compare, "node long, label long"), "links")
    if not sizes.where("blocks > 1").limit(1).count():
        return done
    large = members.where("blocks > 1").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    large = written(_with_text(large.withColumn("unit", F.concat_ws(":", "comp", "block")), docs, "comp", "block", "blocks", broadcast_rows=broadcast_rows).drop("unit"), "large")
    # the most central members: those whose neighbours agree with them most
    degree = pairs.groupBy(F.col("a").alias("node")).agg(F.avg("agree").alias("agree"))
    order = Window.partitionBy("comp").orderBy(F.desc("agree"), "node")
    hubs = (large.select("comp", "node").distinct().join(degree, "node", "left").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= HUBS)
            .select("comp", "node"))
    hub_rows = large.join(hubs, ["comp", "node"], "left_semi").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.concat_ws(":", "comp", "block")
    inside = large.unionByName(hub_rows).select(unit.alias("unit"), "node", "text")
    edges = written(_run_units(inside, _compare, "node long, label long").select(F.col("node").alias("a"), F.col("label").alias("b"))
                    .unionByName(large.select(F.col("node").alias("a"), F.col("node").alias("b"))), "block-links")
    label = _labels(edges, "blocks")
    at = written(large.join(label, "node"), "block-labels")
    main = (at.select("comp", "node", "label").distinct().groupBy("comp", "label").count().groupBy("comp")
            .agg(F.max_by("label", F.struct("count", "label")).alias("main")))
    outer = at.join(main, "comp").where("label != main")
    count = outer.groupBy("comp").agg(F.ceil(F.count("*") / group_docs).cast("int").alias("outer_blocks"))
    outer = outer.join(count, "comp").withColumns({"o": F.pmod(F.xxhash64(F.lit("outer"), "node"), F.col("outer_blocks")).cast("int"),
                                                  "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    inner = at.join(count, "comp").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1)))
    unit = F.concat_ws(":", "comp", "o", "block").alias("unit")
    cross = outer.select(unit, "node", "text", "label", F.lit(0).alias("role")).unionByName(inner.select(unit, "node", "text", "label", F.lit(1).alias("role")))
    more = _run_units(cross, _compare_across, "a long, b long")
    return done.unionByName(_labels(edges.unionByName(more), "all-links"))


def _labels(edges: DataFrame, name: str) -> DataFrame:
    """(node, label) over edges (a, b) that may be loops."""
    alone = edges.select(F.col("a").alias("node")).distinct()
    got = components(edges, name).withColumnRenamed("node", "_node")
    return alone.join(got, alone["node"] == got["_node"], "left").select("node", F.coalesce("comp", "node").alias("label"))


def near_duplicates(docs: DataFrame, group_docs: int = GROUP_DOCS, group_shingles: int = GROUP_SHINGLES,
                    broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) per row of ``docs``."""
    sets = written(document_sets(docs), "sets")
    real = sets.where("doc_id is not null and n_shingles > 0")
    reps = written(real.groupBy("set_hash").agg(F.min(F.struct("doc_id", "text_hash", "n_shingles", "sig")).alias("r"))
                   .select("set_hash", F.col("r.doc_id").alias("node"), "r.text_hash", "r.n_shingles", "r.sig"), "reps")
    # sets of one or two shingles are similar to equal sets only
    found = links(docs, reps, candidate_pairs(reps.where("n_shingles > 2")), group_docs, group_shingles, broadcast_rows)
    # a doc_id with several texts ties their sets together
    several = real.groupBy("doc_id").agg(F.min("set_hash").alias("lo"), F.max("set_hash").alias("hi")).where("lo != hi").limit(1).count()
    label = found.groupBy("node").agg(F.min("label").alias("label"))
    known = reps.select("set_hash", "node").join(label, "node", "left").select("set_hash", F.coalesce("label", "node").alias("component"))
    if several:
        ties = real.join(known, "set_hash").select(F.col("doc_id").alias("a"), F.col("component").alias("b"))
        tied = _labels(ties.union(found.select("node", "label")), "ties").withColumnRenamed("label", "tied")
        known = known.join(tied, known["component"] == tied["node"], "left").select("set_hash", F.coalesce("tied", "component").alias("component"))
    known = written(known, "known").withColumnRenamed("set_hash", "_set")
    out = sets.join(known, sets["set_hash"] == known["_set"], "left")
    comp = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    comp = F.when(F.col("doc_id").isNotNull(), comp)
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(comp == F.col("doc_id"), F.lit(False)).alias("kept"), "text_hash")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component (rows with a null doc_id
    stay; of equal rows with the kept doc_id all stay)."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_near_id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long") == kept["_near_id"], "left").where(F.col("_near_id").isNotNull() | F.col("doc_id").isNull()).select(*docs.columns)
