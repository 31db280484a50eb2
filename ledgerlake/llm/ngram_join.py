"""Operator 4: n-gram Jaccard join and its groups.

Documents are rows of a sparse matrix, hashed 5-word shingles its columns; two
documents link when their shingle sets have a Jaccard similarity of 0.75 or more.
The product of the matrix with its transpose is taken by blocks of columns, and only
where the sizes allow a link:

* Columns that only one document has add nothing. A bounded bitmap of repeated
  shingles (``repeats``) drops them. Columns are ordered by that bit, then by how
  frequent they are, rare first, so common lines and passages come last.
* Of a document of n shingles only the first n - ceil(0.75 n) + 1 columns can be
  the first shared one of a linked pair; and a pair that first meets at position i
  of one and j of the other shares at most min(n - i, m - j): pairs below the
  overlap that their sizes require are dropped (size-derived bounds).
* Per column, one hub document (the one with the fewest columns before it) is held
  against the others first. Verified links make components; after that only pairs
  whose documents are still apart remain, taken exhaustively. So no link between
  components is lost and a group of near copies costs pairs in proportion to its
  size, not to its square.

Overlaps are counted exactly on the full hashed sets (64-bit shingle hashes).
Documents with the same set are one class (128-bit set hash) from the start, and a
task sends one of a class per batch of texts.

Defined results: A-Z are lower-cased; null, empty and blank texts have the empty
set, link with nothing and are their own component; texts of fewer than five words
have one shingle, the whole. Rows that share a doc_id are compared like any others.
Null doc_ids come last; a component of such rows only has a null id. Other columns
pass on (``near_duplicates``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.components import connected_components
from ledgerlake.llm.repeats import Repeats, find_repeats
from ledgerlake.llm.scratch import stored
from ledgerlake.llm.words import LOWER, Words, mix, slices, windows

SIZE = 5
PERCENT = 75
FREQUENT = 1 << 18  # most frequent shingles with a known count (they only set the order)
_LAST = np.iinfo(np.int64).max
_U = np.uint64


def shingle_sets(piece: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sorted and distinct per text; first index per text, with the total at the end)."""
    w = Words(piece, fold=LOWER)
    h = w.hashes()
    code, good = windows(h, w.first, size, seed=50)
    for k in range(1, size):  # shorter texts: the whole text is the one shingle
        short = np.flatnonzero(w.counts == k)
        if len(short):
            whole, _ = windows(h, w.first, k, seed=50 + k)
            at = w.first[short]
            code[at], good[at] = whole[at], True
    sets = code[good]
    n = np.bincount(w.doc[good], minlength=w.n_docs)
    first = np.concatenate([[0], np.cumsum(n)])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        sets[a:b].sort()
    new = np.ones(len(sets), dtype=bool)
    new[1:] = sets[1:] != sets[:-1]
    new[first[:-1][n > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return sets[new], kept[first]


def set_hashes(sets: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128-bit hash of each set; None for the empty set."""
    sums = []
    for salt in (0x5BD1E9955BD1E995, 0x27D4EB2F165667C5):
        total = np.zeros(len(sets) + 1, dtype=np.uint64)
        np.cumsum(mix(sets + _U(salt)), out=total[1:])
        sums.append(total[first[1:]] - total[first[:-1]])
    both = np.column_stack(sums).astype("<u8")
    return [both[i].tobytes() if first[i + 1] > first[i] else None for i in range(len(both))]


def _column_hashes(batch: pa.RecordBatch):
    for _, piece in slices(batch.column("text")):
        sets, first = shingle_sets(piece)
        seen, keep = set(), []
        for i, s in enumerate(set_hashes(sets, first)):
            if s is not None and s not in seen:
                seen.add(s)
                keep.append(sets[first[i]:first[i + 1]])
        if keep:
            yield np.concatenate(keep)


def document_columns(docs: DataFrame, repeats: Repeats, percent: int = PERCENT) -> DataFrame:
    """Per row of docs (id, tag, text): id, tag, n, sig; and for the first of a class in a
    batch that can link at all: its prefix columns, their positions and its whole set."""
    shared = repeats.shared(docs.sparkSession)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("tag", T.LongType()),
                           T.StructField("n", T.LongType()),
                           T.StructField("sig", T.BinaryType()), T.StructField("cols", T.ArrayType(T.LongType())),
                           T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("members", T.BinaryType())])
    arrow = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()),
                       ("cols", pa.list_(pa.int64())), ("at", pa.list_(pa.int32())), ("members", pa.binary())])

    def prefixes(batches):
        known = shared()
        for batch in batches:
            seen = set()
            for lo, piece in slices(batch.column("text")):
                sets, first = shingle_sets(piece)
                sigs = set_hashes(sets, first)
                maybe = known.maybe(sets)
                unique = np.concatenate([[0], np.cumsum(~maybe)])
                n = np.diff(first)
                novel = unique[first[1:]] - unique[first[:-1]]
                most = n - -(-n * percent // 100) + 1
                cols, at, members = [None] * len(n), [None] * len(n), [None] * len(n)
                for i in np.flatnonzero((n > 0) & (novel < most)).tolist():
                    if sigs[i] in seen:
                        continue
                    seen.add(sigs[i])
                    own = sets[first[i]:first[i + 1]]
                    rest = own[maybe[first[i]:first[i + 1]]]
                    order = np.argsort(known.frequency(rest), kind="stable")  # ties: by hash
                    cols[i] = rest[order[:most[i] - novel[i]]].view(np.int64)
                    at[i] = np.arange(novel[i], most[i], dtype=np.int32)[:len(cols[i])]
                    members[i] = own.astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, len(n)), batch.column("tag").slice(lo, len(n)),
                     pa.array(n, pa.int64()), pa.array(sigs, pa.binary()),
                     pa.array(cols, arrow.field("cols").type), pa.array(at, arrow.field("at").type),
                     pa.array(members, pa.binary())], schema=arrow)

    return docs.mapInArrow(prefixes, schema)


@F.arrow_udf(T.LongType())
def _overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        both = np.concatenate([np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")])
        both.sort()
        out.append(int((both[1:] == both[:-1]).sum()))
    return pa.array(out, pa.int64())


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, overlap) of the pairs (a, b) of set hashes that link, by exact overlap."""
    of = lambda k: sets.select(F.col("sig").alias(k), F.col("n").alias(f"n_{k}"), F.col("members").alias(f"m_{k}"))
    counted = pairs.join(of("a"), "a").join(of("b"), "b").withColumn("overlap", _overlap("m_a", "m_b"))
    return counted.filter(f"100 * overlap >= {percent} * (n_a + n_b - overlap)").select("a", "b", "overlap")


def _may_link(n_a: str, p_a: str, n_b: str, p_b: str, percent: int) -> str:
    """Size-derived bounds: of two documents that first meet at positions p_a and p_b."""
    return (f"100 * least({n_a}, {n_b}) >= {percent} * greatest({n_a}, {n_b}) AND "
            f"{100 + percent} * least({n_a} - {p_a}, {n_b} - {p_b}) >= {percent} * ({n_a} + {n_b})")


def linked_classes(columns: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(node, label) of the set classes that link with any other, and the verified
    (a, b, overlap) links that connect them."""
    classes = stored(columns.filter("members IS NOT NULL").groupBy("sig")
                     .agg(*[F.first(c).alias(c) for c in ("n", "cols", "at", "members")]), "classes")
    sets = classes.select("sig", "n", "members")
    postings = (classes.select("sig", "n", F.explode(F.arrays_zip("cols", "at")).alias("c"))
                .select(F.col("c.cols").alias("col"), "sig", "n", F.col("c.at").alias("p")))
    hubs = (postings.groupBy("col").agg(F.count("*").alias("k"), F.min(F.struct("p", "sig", "n")).alias("hub"))
            .filter("k > 1").select("col", F.col("hub.sig").alias("hub"), F.col("hub.n").alias("hub_n"),
                                    F.col("hub.p").alias("hub_p")))
    met = stored(postings.join(hubs, "col"), "postings")
    first = (met.filter("sig <> hub").filter(_may_link("n", "p", "hub_n", "hub_p", percent))
             .select(F.col("hub").alias("a"), F.col("sig").alias("b")).distinct())
    links = stored(verified(first, sets, percent), "hub-links")
    labels = connected_components(links)
    # what the hubs left apart: each member outside its hub's component against all members
    named = (met.join(labels, F.col("sig") == F.col("node"), "left").withColumn("own", F.coalesce("label", "sig"))
             .drop("node", "label")
             .join(labels, F.col("hub") == F.col("node"), "left").withColumn("hub_own", F.coalesce("label", "hub"))
             .select("col", "sig", "n", "p", "own", "hub", "hub_own"))
    named = stored(named, "postings-named")
    apart = named.filter("own <> hub_own").select("col", *[F.col(c).alias(f"{c}_x") for c in ("sig", "n", "p", "own")])
    rest = (apart.join(named.filter("sig <> hub"), "col").filter("own_x <> own")
            .filter(_may_link("n_x", "p_x", "n", "p", percent))
            .select(F.least("sig_x", "sig").alias("a"), F.greatest("sig_x", "sig").alias("b")).distinct())
    more = stored(verified(rest, sets, percent), "further-links")
    name = lambda k: labels.select(F.col("node").alias(k), F.col("label").alias(f"l_{k}"))
    joined = (more.join(name("a"), "a", "left").join(name("b"), "b", "left")
              .select(F.coalesce("l_a", "a").alias("a"), F.coalesce("l_b", "b").alias("b")))
    merged = connected_components(joined)
    up = merged.select(F.col("node").alias("label"), F.col("label").alias("top"))
    old = labels.join(up, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    alone = merged.join(labels.select("node"), "node", "left_anti").select("node", "label")
    return stored(old.unionByName(alone), "classes-linked"), links.unionByName(more)


def document_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, tag, n, component, component_tag) per row of docs: id is doc_id (the largest
    long for null), tag a hash of the text; component is the least (id, tag) of the group."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST))).alias("id"),
                        F.xxhash64("text").alias("tag"), "text")
    repeats = find_repeats(texts.select("text"), _column_hashes, frequent=FREQUENT)
    columns = stored(document_columns(texts, repeats, percent), "columns")
    labels, _ = linked_classes(columns, percent)
    lead = columns.filter("sig IS NOT NULL").groupBy("sig").agg(F.min(F.struct("id", "tag")).alias("least"))
    own = lead.join(labels, F.col("sig") == F.col("node"), "left").withColumn("label", F.coalesce("label", "sig"))
    top = own.groupBy("label").agg(F.min("least").alias("top"))
    named = own.join(top, "label").select("sig", "top")
    return (columns.select("id", "tag", "n", "sig").join(named, "sig", "left")
            .select("id", "tag", "n", F.coalesce("top.id", "id").alias("component"),
                    F.coalesce("top.tag", "tag").alias("component_tag")))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) per row."""
    back = lambda c: F.when(F.col(c) != int(_LAST), F.col(c))
    return document_groups(docs, percent).select(back("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                                 back("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every group: the one with the smallest doc_id. Rows that
    repeat a doc_id and its text are copies of each other; one stays."""
    kept = (document_groups(docs, percent).filter("id = component AND tag = component_tag")
            .select(F.col("id").alias("_id"), F.col("tag").alias("_tag")).distinct())
    keyed = docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST))),
                              "_tag": F.xxhash64("text")})
    return keyed.join(kept, ["_id", "_tag"], "left_semi").dropDuplicates(["_id", "_tag"]).drop("_id", "_tag")
