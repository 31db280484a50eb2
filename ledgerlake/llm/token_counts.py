"""Operator 7: exact token counts at every prefix, by dynamic programming.

For a vocabulary with ranked merges the encoding of a string extends from its
prefixes: the last token of a prefix is the one token that ends there and stays
apart from the last token of what precedes it (the pair encodes to itself), and
the count is the count of that shorter prefix plus one. The recursion runs once
per distinct chunk (a run without white space), for every prefix of the chunk;
the counts of a text are its chunks' counts, shifted by what came before.
``prefix_tokens[i]`` is the token count of the first i code points, so a budget or
a cut is answered by a lookup (``tokens_within``, ``cut_for_budget``).

Counts equal those of the tokenizers library for the vocabulary file (no added
begin or end tokens; special strings inside a text are one token, the library's
default). Null and empty texts have the single prefix count 0. Every row is
counted by itself, so repeated or null ids need no rule; other columns pass on.
"""

from __future__ import annotations

import gc
import json
import re
import sys
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACE = "\t-\r \x85\xa0  -     　"
_CACHE_WORDS = 400_000
_SLICE = 400_000  # code points of prefix counts sent back at a time


class PrefixCounter:
    """Prefix token counts for a vocabulary file with end-of-word merges."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.end = model["end_of_word_suffix"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.vocab = frozenset(model["vocab"])
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocab)
        self.library = Tokenizer.from_file(path)
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(special) + ")") if special else None
        self.marks = {t["content"] for t in spec["added_tokens"]}
        self.inner = frozenset(t for t in self.vocab if not t.endswith(self.end))
        self.closing = frozenset(t.removesuffix(self.end) for t in self.vocab if t.endswith(self.end))
        # node of a token: (follows inside a word, follows as word end, token); the two
        # dictionaries say of a next piece whether it is a token that stays apart
        self.nodes: dict[str, tuple[dict, dict, str]] = {}
        self.known = 0
        self.stems: dict[str, tuple[list, list, list]] = {}
        self.words: dict[str, list[int]] = {}
        self.chunks: dict[str, bytes] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain merging by rank, leftmost first."""
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                r = self.rank.get((symbols[i], symbols[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def stays_apart(self, node: tuple, piece: str, ends: bool) -> bool:
        """Whether ``piece`` is a token that may follow the node's token: the two
        strings together encode to exactly these two tokens."""
        left = node[2]
        if piece not in (self.closing if ends else self.inner):
            got = False
        elif not left:
            got = True
        else:
            symbols = [*left, *piece]
            if ends:
                symbols[-1] += self.end
            got = self.merge(symbols) == [left, piece + self.end if ends else piece]
        node[ends][piece] = got
        self.known += 1
        return got

    def node(self, token: str) -> tuple[dict, dict, str]:
        got = self.nodes.get(token)
        if got is None:
            got = self.nodes[token] = ({}, {}, token)
        return got

    def word_prefixes(self, word: str) -> list[int]:
        """Token count of each prefix 1..n of a pre-token in the byte alphabet, the
        prefix taken as a whole word."""
        got = self.words.get(word)
        if got is not None:
            return got
        if self.known > 3_000_000:
            self.known = 0
            self.nodes.clear()
            self.stems.clear()
        n = len(word)
        for cut in (9, 6, 4, 2):  # states of a known beginning are the same for every word
            known = self.stems.get(word[:cut]) if n > cut else None
            if known:
                nodes, count, out = known[0][:cut + 1], known[1][:cut + 1], known[2][:cut]
                break
        else:
            cut, nodes, count, out = 0, [self.node("")], [0], []
        apart, longest = self.stays_apart, self.longest
        for j in range(cut + 1, n + 1):
            i, low = j - 1, max(0, j - longest)
            step = total = 0
            while i >= low and not (step and total):
                piece, node = word[i:j], nodes[i]
                if not step:
                    ok = node[0].get(piece)
                    if apart(node, piece, False) if ok is None else ok:
                        nodes.append(self.node(piece))
                        step = count[i] + 1
                if not total:
                    ok = node[1].get(piece)
                    if apart(node, piece, True) if ok is None else ok:
                        total = count[i] + 1
                i -= 1
            count.append(step)
            out.append(total)
        if n <= 40:
            if len(self.words) >= _CACHE_WORDS:
                self.words.clear()
                self.stems.clear()
            self.words[word] = out
            for at in (2, 4, 6, 9):
                if at > n:
                    break
                self.stems.setdefault(word[:at], (nodes, count, out))
        return out

    def pretokens(self, text: str) -> list[str]:
        norm = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(norm)]

    def whole(self, text: str) -> int:
        """Token count of a text without special strings, through the same recursion."""
        return sum(self.word_prefixes(w)[-1] for w in self.pretokens(text))

    def plain_chunk(self, text: str) -> list[int]:
        """Counts of the prefixes 1..n of a chunk that holds no special string."""
        if text.isalpha() and text.isascii():
            return self.word_prefixes(text.lower())
        if not _STEADY.fullmatch(text):
            return self.other_chunk(text)
        out: list[int] = []
        done = 0
        for w in _SPLIT.findall(text.lower()):
            if w[0] == "'" and len(w) > 1 and w[1].islower():  # a contraction that is cut splits otherwise
                out += [done + self.whole(w[:j]) for j in range(1, len(w))] + [done + self.word_prefixes(w)[-1]]
            elif w.isascii() and w.isprintable():
                counts = self.word_prefixes(w)
                out += [done + c for c in counts] if done else counts
            else:
                counts = self.word_prefixes(self._bytes(w))
                ends, at = [], -1
                for c in w:
                    at += 1 if c < "\x80" else 2
                    ends.append(at)
                out += [done + counts[i] for i in ends]
            done = out[-1]
        return out

    def other_chunk(self, text: str) -> list[int]:
        """``plain_chunk`` for any characters. A prefix of a text in NFC is in NFC, so the
        library's split of the whole, cut off, is the split of the prefix; texts that
        normalising or lower-casing changes are counted prefix by prefix."""
        low = "".join(c.lower() for c in text)
        if len(low) == len(text) and unicodedata.is_normalized("NFC", text):
            words = self.pretokens(text)
            if sum(map(len, words)) == len(low.encode()):
                out: list[int] = []
                done = at = 0
                for w in words:
                    if w[0] == "'" and w[1:2].islower() and w.isascii():
                        out += [done + self.whole(w[:j]) for j in range(1, len(w))] + [done + self.word_prefixes(w)[-1]]
                        at += len(w)
                    else:
                        counts, used = self.word_prefixes(w), 0
                        while used < len(w):
                            used += len(low[at].encode())
                            at += 1
                            out.append(done + counts[used - 1])
                    done = out[-1]
                return out
        if len(text) <= 64:
            return [self.whole(text[:j]) for j in range(1, len(text) + 1)]
        # a long run without blanks that normalising changes: the library counts its prefixes
        return [len(self.library.encode(text[:j], add_special_tokens=False).ids) for j in range(1, len(text) + 1)]

    def _bytes(self, w: str) -> str:
        return w.encode().decode("latin-1").translate(_STAND_INS)

    def chunk(self, text: str) -> bytes:
        """Prefix counts 1..n of a chunk as 32-bit numbers; the last is the whole's."""
        if self.special and "<|" in text and self.special.search(text):
            out: list[int] = []
            done, before = 0, ""  # count and text since the last special string
            for part in self.special.split(text):
                if part in self.marks:  # cut short it is plain text that continues what stands before it
                    out += [done + self.whole(before + part[:j]) for j in range(1, len(part))]
                    done += (self.whole(before) if before else 0) + 1
                    out.append(done)
                    before = ""
                elif part:
                    out += [done + c for c in self.plain_chunk(part)]
                    before = part
        else:
            out = self.plain_chunk(text)
        got = array("i", out).tobytes()
        if len(text) <= 40:
            if len(self.chunks) >= 2 * _CACHE_WORDS:
                self.chunks.clear()
            self.chunks[text] = got
        return got

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the prefixes 0..n of a text."""
        n = len(text)
        out = np.zeros(n + 1, dtype=np.int32)
        if not n:
            return out
        parts = text.split() if not _ODD.search(text) else _CHUNK.findall(text)
        if not parts:
            return out
        get, build = self.chunks.get, self.chunk
        got = [get(p) or build(p) for p in parts]
        flat = np.frombuffer(b"".join(got), dtype=np.int32)
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lens)
        totals = flat[ends - 1].astype(np.int64)
        before = np.cumsum(totals) - totals
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        blank = _BLANK[np.minimum(code, 0x3001)]
        inside = np.flatnonzero(~blank) + 1
        out[inside] = flat + np.repeat(before, lens)
        gaps = np.flatnonzero(blank) + 1
        if len(gaps):  # white space adds nothing: the count of the chunks that ended before it
            filled = np.searchsorted(inside, gaps)
            chunk = np.searchsorted(ends, filled, side="right")
            out[gaps] = np.concatenate([[0], np.cumsum(totals)])[chunk]
        return out


_CHUNK = re.compile(f"[^{_SPACE}]+")
_ODD = re.compile("[\x1c-\x1f]")
_BLANK = np.zeros(0x3002, dtype=bool)
_BLANK[[i for i in range(0x3002) if re.match(f"[{_SPACE}]", chr(i))]] = True


def _byte_alphabet() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_STAND_INS = _byte_alphabet()
#: Characters below U+0250 normalise and lower-case one by one (but for one that grows); their classes are plain.
_STEADY = re.compile("[\x00-\u012f\u0131-\u024f]+")
_LETTER = "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i))[0] == "L")
_NUMBER = "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i))[0] == "N")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")


def _counter(path: str) -> PrefixCounter:
    """One counter per worker process."""
    kept = sys.__dict__.setdefault("_prefix_counters", {})
    if path not in kept:
        kept[path] = PrefixCounter(path)
    return kept[path]


def token_prefixes(docs: DataFrame, vocabulary: str, keep_text: bool = True) -> DataFrame:
    """``docs`` with prefix_tokens: the token count of every prefix of text."""
    docs = docs.drop("prefix_tokens")
    names = [c for c in docs.columns if keep_text or c != "text"]
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))])

    def count(batches):
        counter = _counter(vocabulary)
        gc.disable()  # the caches hold no cycles, and scanning them again and again is slow
        for batch in batches:
            kept = batch.select(names)
            rows, size, lo = [], 0, 0
            texts = batch.column(batch.schema.get_field_index("text"))
            for i in range(len(texts)):
                rows.append(counter.prefixes(texts[i].as_py() or ""))
                size += len(rows[-1])
                if size >= _SLICE or i + 1 == len(texts):
                    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows), pa.int32()))
                    part = kept.slice(lo, i + 1 - lo)
                    yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*names, "prefix_tokens"])
                    rows, size, lo = [], 0, i + 1

    return docs.mapInArrow(count, schema)


def tokens_within(prefix_tokens: Column, chars: Column) -> Column:
    """Token count of the first ``chars`` code points."""
    return F.element_at(prefix_tokens, F.least(F.greatest(chars, F.lit(0)), F.size(prefix_tokens) - 1) + 1)


def cut_for_budget(prefix_tokens: Column, budget: Column) -> Column:
    """The most leading code points whose count is within ``budget``."""
    return F.size(prefix_tokens) - 1 - F.coalesce(
        F.array_position(F.transform(F.reverse(prefix_tokens), lambda n: n <= budget), F.lit(True)) - 1, F.lit(0))
