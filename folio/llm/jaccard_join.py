"""N-gram Jaccard join (operator 10): near duplicates on five-word shingles at 0.8.

Method: *MinHash LSH forest*.  A text's signature is TREES labels of LEVELS
minimum hashes; the labels of a tree, ordered, are a trie, and texts with equal
prefixes share a node of it.  Matched prefixes start at full length and are
shortened level by level until a pair at the threshold shares a node in some
tree with TARGET_RECALL.  Texts that share a node are candidates; every link is
then verified exactly on the whole sets of shingles.

So that a group of copies costs no pairs: texts with equal sets of shingles are
one class (counted); a trie node links its texts to its smallest one only (in two
steps, so that no task holds a whole node); the candidates' connected components
are verified in blocks of bounded size, a large component as pairs of its blocks;
and a block passes on a spanning forest of its links and each text's number of
links, not the links.

Texts that share a template meet in the tries without being alike.  A component
of more than one block whose texts mostly have trie nodes of their own is therefore
taken apart before any pair is compared (taken apart or not, the links are the same): of
two sets with a Jaccard similarity of at least t, put into one order, the first
|x| - ceil(t |x|) + 1 members of each have one in common; the order is rarest first,
so the members of a template come last.  Only texts that share such a member stay
together.  This loses no link, and costs a row for each such member.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.common import BROADCAST_ROWS, SIMILARITY, WordHashes, map_rows, odd_multipliers, shingle_hashes, table, words_of, written
from folio.llm.components import components

TREES, LEVELS = 24, 6
TARGET_RECALL = 0.99999
LEVEL_BYTES = 2  # of a minimum hash kept in a label
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 1_000_000
SALTS = 16  # a key's texts are linked in this many parts
LOOSE = 0.75  # share of different trie nodes from which a large component is taken apart first (texts at 0.8 share 0.4 with one of them); a matter of cost alone
COUNTER_BITS = 20  # hashed counters of shingles that tell their order: one byte each is broadcast

_MULTIPLIERS = odd_multipliers(TREES * LEVELS, 10)
SIGNED = "doc_id long, key long, node binary, n int, labels array<binary>"


def prefix_depth(similarity: float, target: float = TARGET_RECALL) -> int:
    """The longest prefix, shortened from LEVELS, at which the forest reaches the target recall (1 if none does)."""
    depth = LEVELS
    while depth > 1 and 1 - (1 - similarity**depth) ** TREES < target:
        depth -= 1
    return depth


def shingle_set(text: str | None, known: WordHashes) -> np.ndarray:
    return np.unique(shingle_hashes(words_of(text), known))


def node_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def labels_of(shingles: np.ndarray) -> list[bytes]:
    low = np.full(len(_MULTIPLIERS), ~np.uint64(0))
    for at in range(0, len(shingles), 2048):
        low = np.minimum(low, (shingles[at : at + 2048, None] * _MULTIPLIERS).min(0))
    # the low bits of a minimum are as good as random, its high bits are not
    mixed = (low ^ (low >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    raw = (mixed >> np.uint64(64 - 8 * LEVEL_BYTES)).astype(">u2").tobytes()
    size = LEVELS * LEVEL_BYTES
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def _signed(docs: DataFrame) -> DataFrame:
    def run(slices):
        known = WordHashes()
        for c in slices:
            node, n, labels = [], [], []
            for t in c["text"]:
                s = shingle_set(t, known)
                node.append(node_of(s) if len(s) else None)
                n.append(len(s))
                labels.append(labels_of(s) if len(s) else None)
            yield {"doc_id": c["doc_id"], "key": c["key"], "node": node, "n": n, "labels": labels}

    return map_rows(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text"), run, SIGNED)


def verify_block(shingles: list[np.ndarray], copies: np.ndarray, left: np.ndarray | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of one block: each text's number of linked documents, and a smaller text it is linked to through
    links of the block (itself if none).  ``left`` marks the first of two parts, either of which may be empty (links across only); None: one part."""
    n = len(shingles)
    sizes = np.fromiter(map(len, shingles), np.int64, n)
    owner = np.repeat(np.arange(n), sizes)
    _, column, times = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    kinds, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((n, n), np.float32)
    for at in range(0, len(kinds), 4096):
        lo, hi = np.searchsorted(column, [at, at + 4096])
        x = np.zeros((n, min(4096, len(kinds) - at)), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        common += x @ x.T
    c = common.astype(np.float64)
    linked = c >= similarity * (sizes[:, None] + sizes[None, :] - c) - 1e-9
    np.fill_diagonal(linked, False)
    if left is not None:
        linked &= left[:, None] != left[None, :]
    root = np.arange(n)
    while True:  # smallest reachable text
        low = np.minimum(root, np.where(linked, root[None, :], n).min(1, initial=n))
        low = low[low]
        if (low == root).all():
            break
        root = low
    return linked @ copies, root


def _fetched(docs: DataFrame, members: DataFrame, rest: dict[str, str], use, schema: str) -> DataFrame:
    """``use(node, shingles, *rest)`` for every row of ``members``, whose text is read again; it gives the rows of ``schema``."""
    n = members.count()
    # by id and hash of the text: rows without an id, or of a repeated one, meet their own node only
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("first_doc"), F.xxhash64("text").alias("key"), "text")
    small = F.broadcast(members) if n <= BROADCAST_ROWS // 8 else members  # eight columns' worth of an id
    wanted = texts.join(small.select("first_doc", "key", "node", *rest), ["first_doc", "key"])

    def sets(slices):
        known = WordHashes()
        for c in slices:
            out = []
            for text, node, *more in zip(c["text"], c["node"], *(c[k] for k in rest), strict=True):
                s = shingle_set(text, known)
                if len(s) and node_of(s) == node:  # another text of the same hash
                    out.append(use(node, s, *more))
            yield {f.split()[0]: [r[i] for r in out] for i, f in enumerate(schema.split(", "))}

    return map_rows(wanted, sets, schema)


def stars(keyed: DataFrame) -> DataFrame:
    """u, v: the nodes of a key (columns key, node) linked to its smallest one, by way of the smallest of each of SALTS parts."""
    part = Window.partitionBy("key", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    near = keyed.select("key", "node", F.min("node").over(part).alias("lo"))
    tops = near.filter("node = lo").select("node", F.min("node").over(Window.partitionBy("key")).alias("lo"))
    return near.select("node", "lo").union(tops).filter("node != lo").select(F.col("node").alias("u"), F.col("lo").alias("v"))


def common_least(n: int, similarity: float) -> int:
    """Of n members in a shared order, how many first ones must hold one of any set of at least ``similarity``."""
    return n - int(np.ceil(similarity * n - 1e-9)) + 1


def _slots(shingles: np.ndarray) -> np.ndarray:
    return ((shingles * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def rarity(docs: DataFrame, members: DataFrame) -> np.ndarray:
    """One byte for each hashed counter: four times the binary logarithm of the members' shingles that fall into it."""

    def tally(slices):
        # a task's counters are a fixed array
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for c in slices:
            for raw in c["shingles"]:
                np.add.at(total, _slots(np.frombuffer(raw, np.uint64)), 1)
        has = np.flatnonzero(total)
        yield {"slot": has, "n": total[has]}

    sets = _fetched(docs, members, {}, lambda node, s: (s.tobytes(),), "shingles binary")
    got = map_rows(sets, tally, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most 2^COUNTER_BITS rows
    out = np.zeros(1 << COUNTER_BITS, np.uint8)
    out[got["slot"].to_numpy()] = np.minimum(4 * np.log2(got["n"].to_numpy().astype(float)), 255).astype(np.uint8)
    return out


def taken_apart(docs: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """node, cluster: the components of ``members`` (first_doc, key, node, cluster) by rare shingles they share inside their
    cluster.  Members that share none have no row: they have no link."""
    sent = docs.sparkSession.sparkContext.broadcast(rarity(docs, members))

    def first(node, s, cluster):
        rare = sent.value[_slots(s)]
        return node, cluster, s[np.lexsort((s, rare))[: common_least(len(s), similarity)]].view(np.int64).tolist()

    firsts = _fetched(docs, members, {"cluster": "binary"}, first, "node binary, cluster binary, shingles array<long>")
    keyed = firsts.select("node", "cluster", F.explode("shingles").alias("shingle")).select("node", F.xxhash64("cluster", "shingle").alias("key"))
    return components(stars(keyed)).select("node", F.col("component").alias("cluster"))


def _verified(docs: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """node, other, links: of every text with a link in a block, a smaller linked text and the number of documents."""
    rows = _fetched(
        docs, members, {"cluster": "binary", "part": "int", "parts": "int", "copies": "long"},
        lambda node, s, *rest: (node, *rest, s.tobytes()), "node binary, cluster binary, part int, parts int, copies long, shingles binary",
    )
    spread = rows.withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "node", "copies", "shingles", "part", "cluster", F.least("part", "_q").alias("i"), F.greatest("part", "_q").alias("j")
    )
    out = pa.schema([("node", pa.binary()), ("other", pa.binary()), ("links", pa.int64())])

    def block(t: pa.Table) -> pa.Table:
        seen: dict[bytes, int] = {}
        for at, node in enumerate(t["node"].to_pylist()):
            seen.setdefault(node, at)  # repeated rows of one document
        nodes = sorted(seen)
        at = [seen[x] for x in nodes]
        raw, i, j = t["shingles"], t["i"][0].as_py(), t["j"][0].as_py()
        left = None if i == j else t["part"].to_numpy()[at] == i
        copies = t["copies"].to_numpy()[at].astype(np.float64)
        links, root = verify_block([np.frombuffer(raw[k].as_py(), np.uint64) for k in at], copies, left, similarity)
        has = np.flatnonzero(links > 0)
        return pa.Table.from_arrays(
            [pa.array([nodes[k] for k in has], pa.binary()), pa.array([nodes[root[k]] for k in has], pa.binary()), pa.array(links[has].astype(np.int64))], schema=out
        )

    return spread.groupBy("cluster", "i", "j").applyInArrow(block, "node binary, other binary, links long")


def _in_parts(sized: DataFrame) -> DataFrame:
    """The texts of each cluster (node, cluster, n and others) dealt to parts of bounded size: part, parts."""
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n") / BLOCK_SHINGLES), F.lit(1)).cast("int").alias("parts")
    counted = sized.join(sized.groupBy("cluster").agg(parts), "cluster")
    return counted.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int"))


def _loose(members: DataFrame, trie: DataFrame) -> DataFrame:
    """The clusters whose texts mostly have trie nodes of their own, so that they are hardly copies of each other."""
    few = members.select("node", "cluster").distinct()
    n = few.count()
    keys = trie.join(F.broadcast(few) if n <= BROADCAST_ROWS // 4 else few, "node")
    share = F.approx_count_distinct("key") / F.count("*")
    return keys.groupBy("cluster").agg(share.alias("share")).filter(F.col("share") > LOOSE).select("cluster")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, target: float = TARGET_RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_copies: one row per document row.

    class_id is the smallest doc_id of the documents that links connect with it;
    n_links the number of other documents whose Jaccard similarity with it is at
    least ``similarity`` (copies included), n_copies the number of documents with
    its own set of shingles.  A text of one to four words is one shingle.  Null
    and empty texts, and texts without a word, have no link and are their own
    class.  Null doc_ids take part and are never a class id while the class has another.
    Repeated rows are copies of each other.  Other columns are not read."""
    signed = written(_signed(docs), "signatures")
    depth = prefix_depth(similarity, target)
    nodes = written(
        signed.filter("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"), F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("key"), F.first("n").alias("n"), F.first("labels").alias("labels")),
        "nodes",
    )
    prefix = F.substring("label", 1, depth * LEVEL_BYTES)
    trie = nodes.select("node", F.posexplode("labels").alias("tree", "label")).select("node", F.xxhash64("tree", prefix).alias("key"))
    clusters = components(stars(trie))
    facts = nodes.select("node", "n", "copies", F.coalesce("first_doc", F.lit(-(2**63))).alias("first_doc"), "key")
    sized = written(clusters.select("node", F.col("component").alias("cluster")).join(facts, "node"), "clusters")
    members = _in_parts(sized)
    loose = written(_loose(members.filter("parts > 1"), trie), "loose-clusters")
    if not loose.isEmpty():
        inside = members.join(loose, "cluster", "left_semi").drop("part", "parts")
        inside = written(inside, "loose-members")
        apart = taken_apart(docs, inside, similarity)
        members = members.join(loose, "cluster", "left_anti").unionByName(_in_parts(written(inside.drop("cluster").join(apart, "node"), "clusters-apart")))
    links = written(_verified(docs, members, similarity), "links")
    classes = components(links.select(F.col("node").alias("u"), F.col("other").alias("v")))
    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    info = written(
        nodes.select("node", "copies", "first_doc").join(degree, "node", "left").join(classes, "node", "left").select(
            "node", "copies", "first_doc", F.coalesce("links", F.lit(0)).alias("links"), "component"
        ),
        "classes",
    )
    least = info.filter("component is not null").groupBy("component").agg(F.min("first_doc").alias("least"))
    linked = info.filter("component is not null").join(least, "component").select("node", "copies", "links", F.col("least").alias("class_id"))
    alone = info.filter("component is null").select("node", "copies", "links", F.col("first_doc").alias("class_id"))
    known = signed.filter("node is not null").select("doc_id", "node").join(linked.union(alone), "node")
    wordless = signed.filter("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    return known.select("doc_id", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies")).union(wordless)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
