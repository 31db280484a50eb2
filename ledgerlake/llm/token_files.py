"""Operator 12: token ids in compressed files that can be read document by document.

Format, a folder of three Parquet tables:

* ``blocks``: rows in ascending doc_id order over files named in order (``part`` of a file, ``seq`` in it). A
  row holds about ``BLOCK_IDS`` ids at most (or one document): ``low`` and ``high`` doc_id, ``doc_ids``, ``lengths``
  (ids of each document), ``ends`` (end of each frame), ``frames`` (the documents' zstandard frames one after the
  other), ``start`` (ids of the file before the block) and ``dictionary`` (sha256 of the dictionary).
* ``files``: one row per file: ``part``, ``docs``, ``ids`` and ``base`` (ids of all files before it).
* ``header``: the dictionary, its sha256 and ``width``, the bytes of an id (little-endian; 2 if the vocabulary fits).

Each document is one frame, compressed alone with one dictionary shared by all. The dictionary is trained on the
serialized ids of a bounded sample (``SAMPLE_DOCS`` documents of least hash, ``SAMPLE_IDS`` ids each): it only affects
size, never a result. A reader finds a document by the doc_id range of the blocks (pushed to the Parquet statistics),
the frame by its offset, and decompresses that frame only.

Encoding: where the vocabulary splits texts into words, runs of other characters and dropped white space, after
lower-casing, a text is cut at ASCII white space and, in a piece of letters and then symbols, before the symbols. Each
distinct part goes through the library once per worker, without added special tokens, words many at a time where the
tokens tell their ends; parts over ``LONG`` bytes are encoded each time, and the cache is emptied at ``CACHE`` parts.
A slice of texts is cut in Arrow, looked up once per distinct part and put together in NumPy. With other vocabularies
whole texts are encoded.

Defined results: null and empty texts are the end id alone. Null doc_ids come first; rows of one doc_id go by a hash of
the text, all of them are kept. An empty table gives empty files. Other columns do not matter.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlake.llm.scratch import stored
from ledgerlake.llm.words import slices

END_ID = 2
BLOCK_IDS = 1_000_000
BLOCK_DOCS = 4096
SAMPLE_DOCS = 2000
SAMPLE_IDS = 4096
DICTIONARY = 64 * 1024
LEVEL = 3
LONG = 64
CACHE = 2_000_000
SLICE_BYTES = 4_000_000  # texts are encoded this many bytes at a time; one longer text is encoded alone
RUN = 64  # new words that are given to the library as one text
RUNS = 64  # such texts at a time
#: ASCII symbols but for the apostrophe (contractions) and the sign that special strings begin with.
SYMBOLS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"


class _Pieces:
    """The library with a cache: part of a white-space-free piece -> its ids, serialized."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind, self.code = ("<u2", "H") if id_width(self.library) == 2 else ("<u4", "I")
        self.cut = cuts_words(vocabulary)
        self.closing = closing_ids(vocabulary) if self.cut else None
        self.known: dict[bytes, bytes] = {}

    def _learn(self, parts: list[bytes]) -> None:
        for lo in range(0, len(parts), RUN * RUNS):
            some = parts[lo:lo + RUN * RUNS]
            for p, e in zip(some, self.library.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)):
                self.known[p] = array(self.code, e.ids).tobytes()

    def _learn_words(self, words: list[bytes]) -> None:
        """Letters only: many go through the library as one text, a word ends with each token that closes one."""
        if self.closing is None:
            return self._learn(words)
        known, width, runs = self.known, array(self.code).itemsize, [words[i:i + RUN] for i in range(0, len(words), RUN)]
        for lo in range(0, len(runs), RUNS):
            some = runs[lo:lo + RUNS]
            for run, e in zip(some, self.library.encode_batch_fast([b" ".join(r).decode() for r in some], add_special_tokens=False)):
                ids = np.array(e.ids, self.kind)
                ends = np.flatnonzero(self.closing[ids]) + 1
                if len(ends) != len(run):  # the library cuts one of them
                    self._learn(run)
                    continue
                raw, at = ids.tobytes(), 0
                for word, end in zip(run, (ends * width).tolist()):
                    known[word] = raw[at:end]
                    at = end

    def _parts(self, parts: list[bytes], words: np.ndarray) -> list[bytes]:
        """The ids of distinct parts; ``words``: which are letters only."""
        known = self.known
        out = [known.get(p) for p in parts]
        if None in out:
            new = [i for i, ids in enumerate(out) if ids is None]
            if len(known) + len(new) > CACHE:
                known.clear()
                new = range(len(parts))
            self._learn_words([parts[i] for i in new if words[i]])
            self._learn([parts[i] for i in new if not words[i]])
            out = [known[p] for p in parts]
            for i in new:
                if len(parts[i]) > LONG:
                    del known[parts[i]]
        return out

    def encode_all(self, texts: pa.Array):
        """The serialized ids of each text (strings without nulls), in order."""
        if not self.cut:
            for t in texts:
                yield np.array(self.library.encode(t.as_py(), add_special_tokens=False).ids, self.kind).tobytes()
            return
        for _, some in slices(texts, SLICE_BYTES):
            split = pc.ascii_split_whitespace(some)
            pieces = split.values.dictionary_encode()
            # letters, then symbols: two matches of the pattern; letters alone are the same in lower case
            whole = pieces.dictionary
            word = pc.ascii_rtrim(whole, SYMBOLS)
            cut = pc.utf8_is_alpha(word)
            rest = pc.replace_substring_regex(whole, f"^[^{re.escape(SYMBOLS)}]*", "")
            heads = pc.if_else(cut, pc.ascii_lower(word), whole)
            tails = pc.if_else(cut, rest, pa.scalar("", whole.type))
            parts = pa.concat_arrays([heads, tails]).cast(pa.binary()).dictionary_encode()
            code = parts.indices.to_numpy()
            words = np.zeros(len(parts.dictionary), bool)
            words[code[:len(whole)]] = cut.to_numpy(zero_copy_only=False)
            found = self._parts(parts.dictionary.to_numpy(zero_copy_only=False).tolist(), words)
            ids, ends = np.frombuffer(b"".join(found), self.kind), _ends([len(f) // array(self.code).itemsize for f in found])
            ids, ends = _gather(ids, ends, code.reshape(2, -1).T.ravel())
            ids, ends = _gather(ids, ends[::2], pieces.indices.to_numpy())
            ends = ends[split.offsets.to_numpy()].tolist()
            for lo, hi in zip(ends, ends[1:]):
                yield ids[lo:hi].tobytes()

    def encode(self, text: bytes) -> bytes:
        return next(self.encode_all(pa.array([text.decode()], pa.string())))


def _ends(sizes) -> np.ndarray:
    """0 and the running sums."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _gather(values: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen runs of ``values`` one after the other, and their ends; run i is ``values[ends[i]:ends[i + 1]]``."""
    sizes = np.diff(ends)[chosen]
    out = _ends(sizes)
    at = np.repeat(ends[chosen] - out[:-1], sizes)
    at += np.arange(len(at))
    return values[at], out


def cuts_words(vocabulary: str) -> bool:
    """Whether the vocabulary lower-cases texts in composed form and then keeps the matches of one pattern, in
    which letters, symbols and white space never go together, and no special string spans such a cut."""
    with open(vocabulary, encoding="utf-8") as f:
        rules = json.load(f)
    first, normal = ((rules.get(step) or {}) for step in ("pre_tokenizer", "normalizer"))
    first = first.get("pretokenizers", [first])[0]
    if first.get("type") != "Split" or first["behavior"] != "Removed" or not first["invert"] or "Regex" not in first["pattern"]:
        return False
    kinds = [n["type"] for n in normal.get("normalizers", [normal]) if n.get("type") != "Replace"]
    pattern = first["pattern"]["Regex"]
    found = regex.findall(pattern, "a.é?\tb; \nc!:\x0bd,\x0ce\rß")
    return (kinds == ["NFC", "Lowercase"] and found == ["a", ".", "é", "?", "b", ";", "c", "!:", "d", ",", "e", "ß"]
            and all(regex.findall(pattern, f"é{s}") == ["é", s] for s in SYMBOLS)
            and all(re.fullmatch(r"\S*<\S*", t["content"]) for t in rules.get("added_tokens") or []))


def closing_ids(vocabulary: str) -> np.ndarray | None:
    """Of each id, whether it ends a match of the pattern; None where tokens do not tell, or bytes are missing."""
    from tokenizers.pre_tokenizers import ByteLevel
    with open(vocabulary, encoding="utf-8") as f:
        rules = json.load(f)
    mark, tokens = rules["model"].get("end_of_word_suffix"), rules["model"]["vocab"]
    bytewise = rules["pre_tokenizer"].get("pretokenizers", [{}])[-1].get("type") == "ByteLevel"
    if not mark or not bytewise or any(c not in tokens or c + mark not in tokens for c in ByteLevel.alphabet()):
        return None
    out = np.zeros(max([*tokens.values(), *(t["id"] for t in rules.get("added_tokens") or [])]) + 1, bool)
    out[[i for t, i in tokens.items() if t.endswith(mark)]] = True
    return out


def id_width(tokenizer) -> int:
    return 2 if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def _pieces(vocabulary: str) -> _Pieces:
    """A worker process keeps its cache from task to task, in a module of its own: this package comes anew with every
    task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core
    kept = sys.modules.setdefault("token_files_cache", types.ModuleType("token_files_cache")).__dict__
    if vocabulary not in kept:
        kept[vocabulary] = _Pieces(vocabulary)
    return kept[vocabulary]


def _encoder(vocabulary: str, end_id: int):
    """bytes of a text -> its serialized ids with the end id."""
    pieces = _pieces(vocabulary)
    end = np.array([end_id], pieces.kind).tobytes()
    return lambda text: pieces.encode(text) + end


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> bytes:
    """A zstandard dictionary from the ids of SAMPLE_DOCS documents at most; empty where the sample is too small."""
    def ids(batches):
        encode = _encoder(vocabulary, end_id)
        for batch in batches:
            out = [encode((t.as_py() or "").encode())[:SAMPLE_IDS * 2] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])

    order = F.xxhash64("doc_id")
    most = -(1 << 63) + (1 << 64) * 2 * SAMPLE_DOCS // max(2 * SAMPLE_DOCS, docs.count())  # about twice as many pass
    sample = (docs.select("doc_id", "text").filter(order <= F.lit(min(most, (1 << 63) - 1))).orderBy(order, "doc_id")
              .limit(SAMPLE_DOCS).select("text").mapInArrow(ids, "ids binary"))
    samples = [bytes(r["ids"]) for r in sample.collect()]  # at most SAMPLE_DOCS * SAMPLE_IDS ids
    size = min(DICTIONARY, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if size >= 1024 else b""
    except zstandard.ZstdError:  # too few or too equal samples: frames do without
        return b""


def _compressor(dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress


def _decompressor(dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=shared).decompress


def _frames(docs: DataFrame, vocabulary: str, dictionary: bytes, end_id: int) -> DataFrame:
    """doc_id, order, length, frame: each document compressed alone."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("place", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("frame", T.BinaryType())])

    def pack(batches):
        pieces, compress = _pieces(vocabulary), _compressor(dictionary)
        end = np.array([end_id], pieces.kind).tobytes()
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            lo, size, lengths, frames = 0, 0, [], []
            for i, ids in enumerate(pieces.encode_all(texts)):
                ids += end
                lengths.append(len(ids))
                frames.append(compress(ids))
                size += len(frames[-1])
                if size > 8_000_000 or i + 1 == len(texts):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(lo, len(frames)), batch.column("place").slice(lo, len(frames)),
                         pa.array(lengths, pa.int64()), pa.array(frames, pa.binary())], names=schema.names)
                    lo, size, lengths, frames = i + 1, 0, [], []

    return docs.select("doc_id", F.xxhash64("text").alias("place"), "text").mapInArrow(pack, schema)


def write_ids(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> None:
    """Encode doc_id and text of ``docs`` into token files under ``path``."""
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    width = id_width(Tokenizer.from_file(vocabulary))
    dictionary = train_dictionary(docs, vocabulary, end_id)
    mark = hashlib.sha256(dictionary).hexdigest()
    (spark.createDataFrame([(bytearray(dictionary), mark, width)], "content binary, dictionary string, width int")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/header"))
    key = docs.schema["doc_id"].dataType.simpleString()
    frames = stored(_frames(docs, vocabulary, dictionary, end_id), "frames")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = frames.repartitionByRange(parts, "doc_id", "place").sortWithinPartitions("doc_id", "place", "length")
    schema = T.StructType.fromDDL(f"part int, seq long, start long, ids long, low {key}, high {key}, doc_ids array<{key}>, "
                                  "lengths array<long>, ends array<long>, frames binary, dictionary string")
    shape = to_arrow_schema(schema)

    def pack(batches):
        part, seq, start, held = TaskContext.get().partitionId(), 0, 0, 0
        ids, lengths, frames = [], [], []

        def block():
            known = [i for i in ids if i is not None]
            row = (part, seq, start, held, known[0] if known else None, known[-1] if known else None, ids, lengths,
                   np.cumsum([len(f) for f in frames]).tolist(), b"".join(frames), mark)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, shape.types)], schema=shape)

        for batch in batches:
            for i, n, f in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "length", "frame"))):
                ids.append(i)
                lengths.append(n // width)
                frames.append(f)
                held += lengths[-1]
                if held >= BLOCK_IDS or len(ids) == BLOCK_DOCS:
                    yield block()
                    start, seq, held = start + held, seq + 1, 0
                    ids, lengths, frames = [], [], []
        if ids:
            yield block()

    # the frames are compressed already
    ordered.mapInArrow(pack, schema).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/blocks")
    files = (spark.read.schema(schema).parquet(f"{path}/blocks").groupBy("part")
             .agg(F.sum(F.size("doc_ids").cast("long")).alias("docs"), F.sum("ids").alias("ids")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    (files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/files"))


def read_ids(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit), from the files.
    doc_ids: only these documents; other blocks are skipped by their range, other frames are not decompressed."""
    header = spark.read.parquet(f"{path}/header").first()
    dictionary, mark, width = bytes(header["content"]), header["dictionary"], header["width"]
    if hashlib.sha256(dictionary).hexdigest() != mark:
        raise ValueError(f"{path}: the dictionary does not have the hash of the header")
    blocks = spark.read.parquet(f"{path}/blocks")
    wanted = None
    if doc_ids is not None:
        wanted = set(doc_ids)
        ranges = [(F.col("low") <= i) & (F.col("high") >= i) for i in sorted(wanted)]
        blocks = blocks.filter(functools.reduce(lambda a, b: a | b, ranges, F.lit(False)))
    blocks = blocks.join(spark.read.parquet(f"{path}/files").select("part", "base"), "part").withColumn("start", F.col("base") + F.col("start"))
    key = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = T.StructType.fromDDL(f"doc_id {key}, start long, n_tokens long, ids binary")
    shape = to_arrow_schema(schema)

    def unpack(batches):
        decompress = _decompressor(dictionary)
        for batch in batches:
            for k in range(batch.num_rows):
                start, ids, lengths, ends, of = (batch.column(c)[k].as_py() for c in ("start", "doc_ids", "lengths", "ends", "dictionary"))
                if of != mark:
                    raise ValueError(f"{path}: a block needs another dictionary: {of}")
                frames = memoryview(batch.column("frames")[k].as_buffer())
                out, at = [], 0
                for i, n, end in zip(ids, lengths, ends):
                    if wanted is None or i in wanted:
                        raw = np.frombuffer(decompress(frames[at:end], max_output_size=n * width), f"<u{width}")
                        out.append((i, start, n, raw.astype("<u4").tobytes()))
                    start, at = start + n, end
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), shape.types)], schema=shape)

    return blocks.select("start", "doc_ids", "lengths", "ends", "frames", "dictionary").mapInArrow(unpack, schema)
