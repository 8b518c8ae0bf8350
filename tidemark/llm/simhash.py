"""SimHash fingerprints of documents and near-duplicate classes by BK-trees."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, text_batches
from tidemark.llm.components import components

TREE_NODES = 4096


def shingle_hashes(text: str, words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each shingle of ``words`` words joined by a space, repeats included.

    A-Z are lower-cased and words are separated by ASCII white space. Fewer words than a shingle has
    give one shingle of them all, no word gives none.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    n = max(1, len(found) - words + 1)
    parts = [found[i : i + n] for i in range(min(words, len(found)))]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(x, seed) for x in map(b" ".join, zip(*parts, strict=True))], "<u8")


def _majority(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """64 bits: bit b is set if it is set in over half of the shingles' hashes; zero without a word."""
    return _majority(shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of documents (doc_id, text), fp as a signed bigint; null text counts as empty."""

    def run(batches):
        for keys, texts in text_batches(batches):
            fps = np.array([fingerprint(x, words, seed) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fps)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


class BKTree:
    """Fingerprints in a tree whose children are keyed by their Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.names: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int, name: int) -> None:
        at = 0 if self.values else -1
        while at >= 0:
            d = (value ^ self.values[at]).bit_count()
            down = self.children[at].get(d)
            if down is None:
                self.children[at][d] = len(self.values)
                at = -1
            else:
                at = down
        self.values.append(value)
        self.names.append(name)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Names of all values within ``radius``: only edges d with |d - distance| <= radius are followed."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= radius:
                found.append(self.names[at])
            children = self.children[at]
            if len(children) <= 2 * radius + 1:
                todo += [down for e, down in children.items() if -radius <= e - d <= radius]
            else:
                todo += [children[e] for e in range(d - radius, d + radius + 1) if e in children]
        return found


def shard_keys(fp: Column, radius: int, bands: int) -> Column:
    """The shards of a fingerprint: each choice of bands - radius whole bands of the 64 bits.

    Two fingerprints within ``radius`` bits differ in at most that many bands, so they share a shard.
    """
    edges = [64 * i // bands for i in range(bands + 1)]
    keys = []
    for k, chosen in enumerate(combinations(range(bands), bands - radius)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(k).alias("k"), fp.bitwiseAND(F.lit(mask)).alias("v")))
    return F.array(*keys)


def near_pairs(classes: DataFrame, radius: int = 3, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Links a < b that connect all nodes whose fingerprints differ in at most ``radius`` bits.

    ``classes`` holds each fingerprint once: (node, fp). Shards are found by bands of bits, with more
    bands the more fingerprints there are, so that a shard stays small.
    """
    n, bands = classes.count(), radius + 1
    while bands < 2 * radius + 2 and n >> (64 * (bands - radius) // bands) > 1000:
        bands += 1
    keyed = classes.select("node", "fp", F.explode(shard_keys(F.col("fp"), radius, bands)).alias("s")).select("s.k", "s.v", "node", "fp")
    return tree_links(dealt_to_trees(keyed, tree_nodes), radius)


def dealt_to_trees(keyed: DataFrame, tree_nodes: int) -> DataFrame:
    """Members (k, v, node, ...) of shards with two or more nodes, with the tree (i, j) that each builds or asks.

    A shard of more than ``tree_nodes`` members is dealt into several trees, and every piece of it is
    sent to every tree, so the largest shard neither meets in one task nor loses a pair. Trees go to
    their queries by the shuffle and not by one broadcast, because all of them grow with the data.
    """
    sizes = keyed.groupBy("k", "v").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.select(F.col("k").alias("k2"), F.col("v").alias("v2"), "n")
    sizes = staged(sizes, "shard-sizes")  # so that the join shuffles both sides itself and can split a hot shard
    pieces = F.ceil(F.col("n") / tree_nodes).cast("int")
    met = keyed.join(sizes, (F.col("k") == F.col("k2")) & (F.col("v") == F.col("v2"))).withColumn("own", F.pmod(F.xxhash64("node"), pieces))
    # A piece builds the trees (own, j) of later pieces j and asks those of earlier ones.
    ask = F.transform(F.sequence(F.lit(0), pieces - 1), lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")))
    return met.withColumn("at", F.explode(ask)).select(
        *keyed.columns, F.col("at.i").alias("i"), F.col("at.j").alias("j"), (F.col("own") != F.col("at.i")).alias("asks")
    )


def tree_links(members: DataFrame, radius: int) -> DataFrame:
    """Links a < b found in the trees of members (k, v, i, j, asks, node, fp).

    Within a tree a link between nodes that earlier links connect is left out, so a tree gives fewer
    links than it has members and the components stay the same.
    """
    order = ["k", "v", "i", "j"]

    def search(batches):
        group, tree, above = None, BKTree(), {}

        def top(x):
            while above.get(x, x) != x:
                above[x] = x = above.get(above[x], above[x])
            return x

        for batch in batches:
            a, b = [], []
            for *key, asks, node, fp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fp &= (1 << 64) - 1
                if key != group:
                    group, tree, above = key, BKTree(), {}
                if asks or key[2] == key[3]:
                    for other in tree.within(fp, radius):
                        mine, theirs = top(node), top(other)
                        if mine != theirs:
                            above[mine] = theirs
                            a.append(min(node, other))
                            b.append(max(node, other))
                if not asks:
                    tree.add(fp, node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = members.select(*order, "asks", "node", "fp").repartition(*order).sortWithinPartitions(*order, "asks", "node")
    return rows.mapInArrow(search, "a bigint, b bigint").distinct()


def first_of_each_group(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """The row of ``docs`` (doc_id, text, ...) with the smallest doc_id of each group of :func:`near_duplicates`.

    Of rows repeated under that doc_id all stay; rows with a null doc_id stay, as nothing names them. Other
    columns are kept, whatever their names.
    """
    groups = near_duplicates(docs, words, radius=radius).filter("doc_id IS NOT NULL")
    first = groups.select(F.col("component_id").alias("_first_of_group")).distinct()
    kept = docs.join(staged(first, "first-of-groups"), F.col("doc_id") == F.col("_first_of_group"), "left_semi")
    return kept.unionByName(docs.filter("doc_id IS NULL"))


def near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every document; component_id is the smallest doc_id reachable.

    Links join fingerprints that differ in at most ``radius`` bits, equal ones included. Copies are
    one node until the end. Null texts and texts without a word have fingerprint zero and link like
    any other. Rows with a null doc_id keep a null component_id; a repeated doc_id gives a row each, and
    its texts are one document, so their links are shared.
    """
    fps = staged(fingerprints(docs, words, seed), "fingerprints")
    classes = staged(fps.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "fingerprint-classes")
    found = components(near_pairs(classes, radius))
    named = classes.join(found, "node", "left").select(F.col("fp").alias("fp2"), F.coalesce("component", "node").alias("component_id"))
    named = staged(named, "fingerprint-components")
    with_id = fps.join(named, F.col("fp") == F.col("fp2"), "left")
    return with_id.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
