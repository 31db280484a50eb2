"""Conversation repair, token files and collocations against plain Python and the tokenizer's own library."""

import json
import random
import zlib

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import collocations as C
from ledgerlake.llm import conversation_repair as R
from ledgerlake.llm import queries
from ledgerlake.llm import token_files as T
from ledgerlake.sources.tables import run_folder

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


# -- conversations ----------------------------------------------------------------

def _conversations(rng, conv, n, late=0):
    texts = ["Well said.", "no end", "", " \t", "Really?", "same.", None, "é ü!", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "agent"]
    return [(conv, rng.choice([None, late + k, late + k // 2]) if rng.random() < 0.2 else late + k,
             rng.choices(roles, [8, 8, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts)) for k in range(n)]


def _check(spark, rows, types="conv_id long, turn long, role string, text string"):
    df = spark.createDataFrame(rows, types).repartition(5)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in R.audits(R.damage(df)).collect()}
    want = {c: plain.repair(rs) for c, rs in plain.damaged(rows).items()}
    assert set(got) == set(want)
    for c in want:
        assert got[c] == want[c], c
    return got


def test_repairs_equal_an_exhaustive_search(spark):
    rng = random.Random(11)
    rows = [r for conv in range(120) for r in _conversations(rng, conv, rng.randint(1, 9))]
    rows += _conversations(rng, None, 6) + [(500, None, "user", "a."), (500, None, None, None)] + [(501, 3, "user", "same.")] * 4
    _check(spark, rows)


def test_long_conversations_are_cut_and_chained(spark, monkeypatch):
    """Blocks of 7 rows over many partitions: one conversation has most rows of the table."""
    monkeypatch.setattr(R, "BLOCK", 7)
    rng = random.Random(5)
    rows = _conversations(rng, 1, 400) + _conversations(rng, 2, 90, late=7) + [r for c in range(3, 30) for r in _conversations(rng, c, 5)]
    got = _check(spark, rows)
    assert len(got[1][6]) > 300


def test_a_long_conversation_in_full_blocks(spark):
    rng = random.Random(8)
    roles = ["system", *["user", "assistant"] * 800]
    rows = [(1, k, r if rng.random() < 0.9 else "user", "text ends." if rng.random() < 0.8 else f"open {k}") for k, r in enumerate(roles)]
    _check(spark, rows)


def test_the_search_is_exact_between_any_states():
    rng = random.Random(2)
    for _ in range(150):
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3]) + 4 * rng.choice([0, 0, 1, 2]) for _ in range(rng.randint(0, 6)))
        for goal in range(4):
            found = R.search(codes, goal, range(4))
            for entry in range(4):
                best = {entry: (0, "")}
                for code in codes:
                    to = {}
                    states = dict(best)
                    for _ in range(3):
                        for s, (c, p) in list(states.items()):
                            states[R.NEXT[s]] = min(states.get(R.NEXT[s], (99999, "")), (c + 3, p + "I"))
                    for s, (c, p) in states.items():
                        role, fault, due = code & 3, code >> 2, R.NEXT[s]
                        moves = [(s, c + 4, "D")]
                        if fault < 2:
                            moves.append((due, c + 3 + 3 * fault, "R"))
                            if role == due or role == R.SYSTEM and s == R.START:
                                moves.append((role, c + 3 * fault, "K"))
                        for t, cost, edit in moves:
                            to[t] = min(to.get(t, (99999, "")), (cost, p + edit))
                    best = to
                assert found.get(entry) == best.get(goal), (list(codes), entry, goal)


def test_repaired_messages_are_the_digest(spark):
    rows = R.damage(spark.read.parquet(f"{SF}/conversations.parquet"))
    said = (R.repaired(rows).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text", "edit"))).alias("m"))
            .select("conv_id", F.sha2(F.array_join(F.transform("m", lambda m: F.concat(m.role, F.lit(":"), m.text)), "\n"), 256).alias("sha"),
                    F.array_join(F.transform("m", lambda m: m.edit), "").alias("edits")))
    both = R.audits(rows).join(said, "conv_id", "left").collect()
    assert both and all(r.audit.replace("D", "") == (r.edits or "") for r in both)
    assert all(r.repaired_sha256 == r.sha for r in both if r.edits)
    legal = R.repaired(rows).filter("NOT (substring(role, 1, 1) IN ('s', 'u', 'a'))")
    assert legal.count() == 0


def test_conversations_without_rows_and_clashing_columns(spark):
    types = "conv_id long, turn long, role string, text string, kind int, copies string, mark string, part int, path string"
    assert R.audits(R.damage(spark.createDataFrame([], types))).count() == 0
    dropped = [(c, 0) for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = [(*k, "user", "gone.", 1, "x", "y", 2, "z") for k in dropped]
    got = R.audits(R.damage(spark.createDataFrame(rows, types))).collect()
    assert len(got) == 3 and all(tuple(r)[1:7] == (0,) * 6 and r.audit == "" for r in got)
    assert {r.repaired_sha256 for r in got} == {"e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"}


# -- token files --------------------------------------------------------------------

def _library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(VOCABULARY)


def _wanted(rows):
    library, start, out = _library(), 0, []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [T.END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_give_what_the_library_gives(spark, table):
    docs = table("documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in queries.op12_token_files(spark, SF).collect())
    assert got == _wanted(rows)


def test_token_files_of_awkward_documents(spark, awkward, nothing, monkeypatch):
    """Nulls, empty and very long texts, special strings, equal ids; small blocks; an empty table."""
    monkeypatch.setattr(T, "BLOCK_DOCS", 3)
    path = f"{run_folder(spark)}/tokens"
    T.write_ids(awkward, VOCABULARY, path)
    got = T.read_ids(spark, path).collect()
    rows = awkward.select("doc_id", "text").collect()
    library = _library()
    size = lambda t: len(library.encode(t or "", add_special_tokens=False).ids) + 1
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted((r.doc_id or -1, size(r.text)) for r in rows)
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == list(np.cumsum([0, *[r.n_tokens for r in order]])[:-1])
    assert [r.doc_id or -1 for r in order] == sorted(r.doc_id or -1 for r in got)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert ids[-1] == T.END_ID and len(ids) == r.n_tokens
        assert any(ids[:-1].tolist() == library.encode(x.text or "", add_special_tokens=False).ids for x in rows if x.doc_id == r.doc_id)
    one = T.read_ids(spark, path, doc_ids=[7, 9])
    assert sorted((r.doc_id, r.start, bytes(r.ids)) for r in one.collect()) == sorted((r.doc_id, r.start, bytes(r.ids)) for r in got if r.doc_id in (7, 9))
    assert "GreaterThanOrEqual(high,7)" in one._jdf.queryExecution().executedPlan().toString()
    empty = f"{run_folder(spark)}/empty"
    T.write_ids(nothing, VOCABULARY, empty)
    assert T.read_ids(spark, empty).count() == 0


def test_files_name_their_dictionary(spark, table):
    path = f"{run_folder(spark)}/tokens"
    T.write_ids(table("documents"), VOCABULARY, path)
    header = spark.read.parquet(f"{path}/header").first()
    assert len(header.content) > 1000 and header.width == 2
    assert [r[0] for r in spark.read.parquet(f"{path}/blocks").select("dictionary").distinct().collect()] == [header.dictionary]
    spark.createDataFrame([(bytearray(b"another"), header.dictionary, 2)], "content binary, dictionary string, width int") \
        .write.mode("overwrite").parquet(f"{path}/header")
    with pytest.raises(ValueError, match="hash"):
        T.read_ids(spark, path)


def test_pieces_are_cut_only_where_the_vocabulary_drops_blanks():
    assert T.cuts_words(VOCABULARY) and not T.cuts_words(public_tokenizers.path("byte_bpe_50k.json"))
    encode, library = T._encoder(VOCABULARY, 2), _library()
    rng = random.Random(3)
    alphabet = "aB é́ßΣ \t\n\r\x0b\x0c\x1c\x85  'sl!?1٣中<|endoftext|>"
    for _ in range(300):
        text = "".join(rng.choice(rng.choice([alphabet, "aBÉ.,!ΣǅẖH\u0331\u1100\u1161 "])) for _ in range(rng.randint(0, 60))) + rng.choice(["", "<|endoftext|>", " it's <|startoftext|>x"])
        assert np.frombuffer(encode(text.encode()), "<u2")[:-1].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_new_words_go_through_the_library_many_at_a_time():
    """Each word once for all of its forms, in a few long texts; before, each piece was a text of its own."""
    class Counted:
        def __init__(self, library):
            self.library, self.texts = library, 0

        def encode_batch_fast(self, texts, **kw):
            self.texts += len(texts)
            return self.library.encode_batch_fast(texts, **kw)

    rng = random.Random(11)
    words = sorted({"".join(rng.choice("abcdeéñß") for _ in range(rng.randint(3, 9))) for _ in range(2000)})
    form = lambda w: rng.choice([w, "".join(c.upper() if c < "z" else c for c in w)]) + rng.choice(["", "", ".", "!!", "***", "-", ")]"])
    texts = [" ".join(form(w) for w in rng.sample(words, len(words))) for _ in range(3)]
    pieces = T._Pieces(VOCABULARY)
    library = pieces.library
    pieces.library = Counted(library)
    got = [np.frombuffer(x, "<u2").tolist() for x in pieces.encode_all(pa.array(texts))]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert pieces.library.texts < len(words) / T.RUN + 20 and len(pieces.known) < len(words) + 20


def test_slices_of_texts_give_what_the_library_gives(monkeypatch):
    """Words that the library cuts among others, symbols, special strings, empty texts; small slices and caches."""
    rng, library = random.Random(5), _library()
    odd = ["it's", "'say***", "a<b", "x<|endoftext|>***", "<|ENDOFTEXT|>", "İstanbul", "ΣΑΣ", "\u0958\u0915", "H\u0331", "e\u0301.", "१२३", "a\x1cb",
           "word.'", "word\u2019s", "***", "a" * 100 + "!!", "ǅ(", "\u1100\u1161", "中文。", "x_y_", "5%", "A/", "\U0002ebf0"]
    plain = ["".join(rng.choice("abcdeE") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    texts = ["", " ", *(rng.choice(" \n") + rng.choice([" ", "\t ", "\x0b", "\x85"]).join(
        rng.choice(odd if rng.random() < 0.2 else plain) + rng.choice(["", "", ",", "$$", "~`"]) for _ in range(rng.randint(0, 60))) for _ in range(200)), ""]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for size, cache in ((1 << 20, 1 << 20), (1 << 20, 50), (300, 400), (1, 1)):
        monkeypatch.setattr(T, "SLICE_BYTES", size)
        monkeypatch.setattr(T, "CACHE", cache)
        pieces = T._Pieces(VOCABULARY)
        got = [np.frombuffer(x, "<u2").tolist() for x in pieces.encode_all(pa.array(["cut off", *texts]).slice(1))]
        assert got == want
        assert not any(len(p) > T.LONG for p in pieces.known)


def test_special_strings_that_a_cut_could_break(tmp_path):
    """Other vocabularies: special strings of letters or with blanks."""
    for content in ("foo", "<my string>", "d."):
        with open(VOCABULARY, encoding="utf-8") as f:
            rules = json.load(f)
        rules["added_tokens"].append({**rules["added_tokens"][0], "id": 49408, "content": content})
        path = str(tmp_path / f"{len(content)}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(rules, f)
        text = f"Food and.. {content} fooD. a{content}b"
        pieces = T._Pieces(path)
        assert np.frombuffer(pieces.encode(text.encode()), "<u2").tolist() == pieces.library.encode(text, add_special_tokens=False).ids


# -- phrases --------------------------------------------------------------------------

def _phrases(spark, rows, **kw):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


def _corpus():
    rng = random.Random(7)
    words = ["the", "The", "of", "a", "on", "new", "york", "city", "é", "ß\x00", "x-y"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", "\t ", ". ", "\n", ", "]) for _ in range(n))
    rows = [(rng.choice(["en", "de", None]), text(rng.randint(0, 60))) for _ in range(150)]
    rows += [("en", "in New York City today. new york city hall")] * 40 + [("en", None), (None, ""), ("fr", " . ; "), ("und", "a b " * 300)]
    return rows


def test_collocations_equal_plain_counts(spark):
    rows = _corpus()
    for least, top in ((5, 2000), (20, 7)):
        assert _phrases(spark, rows, least=least, top=top) == plain.phrases(rows, least, top)


def test_summaries_that_are_cut_lose_no_frequent_phrase(spark, monkeypatch):
    """Small capacities, flushes and filters: many merges, many rounds, the same result."""
    rows = _corpus()
    want = plain.phrases(rows, 15, 2000)
    monkeypatch.setattr(C, "MERGE", 50)
    monkeypatch.setattr(C, "FLUSH", 400)
    monkeypatch.setattr(C, "FILTER_BITS", 1 << 14)
    assert want and _phrases(spark, rows, least=15) == want


def test_merges_keep_what_passes_the_threshold():
    rng = np.random.default_rng(4)
    for _ in range(30):
        keys = np.minimum(rng.zipf(1.3, 4000), 3000).astype(np.uint32)
        least = int(rng.integers(20, 200))
        capacity, held, taken = len(keys) // least + 1, (np.zeros(0, np.uint32), np.zeros(0, np.int64)), 0
        for part in np.array_split(keys, 13):
            k, c = np.unique(part, return_counts=True)
            *held, cut = C._merge(held, k, c.astype(np.int64), capacity)
            taken += cut
        k, c = np.unique(keys, return_counts=True)
        assert len(held[0]) <= capacity and taken < least
        assert set(k[c >= least]) <= set(held[0][held[1] + taken >= least])


def test_collocations_of_awkward_documents(spark, awkward, nothing):
    assert C.collocations(nothing).count() == 0
    rows = [(r.lang, r.text) for r in awkward.select("lang", "text").collect()]
    got = sorted(tuple(r) for r in C.collocations(awkward, least=12).collect())
    assert got and got == plain.phrases(rows, 12, 2000)
