"""Collocations, byte-pair encoding and conversation repair against plain versions, and on awkward tables."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obsledger.llm import bpe, dialogue, phrases, registered

DOCS = "doc_id long, text string, lang string"


# ---- collocations

def plain_collocations(rows, least, top, within):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split("[ \t]", piece) if w]
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        inside = {p[i:j] for p in candidates for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and 100 * f[p] >= within * f[p[i:j]]}
        scored = []
        for p in set(candidates) - inside:
            score, k = min((1000 * f[p] * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def texts_of_phrases(n=120):
    rnd = random.Random(5)
    words = ["the", "of", "Éa", "x", "TEA", "tea", "a\x1cb", "ß", "q\x85", "longer" * 30]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(0, 25)):
            parts.append(rnd.choice(["new york city hall", "the the", rnd.choice(words), rnd.choice(words), "of  the\tsea"]))
            parts.append(rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0c", "?!"]))
        rows.append((i, "".join(parts), rnd.choice(["en", "fr", None, "und"])))
    return rows + [(1, None, "en"), (None, "", None), (2, "the the " * 3000, "en"), *rows[:5]]


LIMITS = [{}, {"lexicon": 3}, {"full": 20, "burst": 2, "per_range": 100}, {"lexicon": 0, "full": 50, "burst": 3, "per_range": 50}]


@pytest.mark.parametrize("limits", LIMITS)
def test_collocations_by_brute_force(spark, limits):
    rows = texts_of_phrases()
    docs = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("key", F.lit(1)).withColumn("word", F.lit("x"))
    for least, top, within in ((4, 2000, 100), (2, 7, 60)):
        got = sorted(map(tuple, phrases.collocations(docs, least=least, top=top, within=within, **limits).collect()))
        assert got == plain_collocations([(r[2], r[1]) for r in rows], least, top, within)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert phrases.collocations(docs).count() == 0
    docs = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, " \n.", "en")], DOCS)
    assert phrases.collocations(docs, least=1).count() == 0


def test_scores_pass_64_bits(spark):
    words = spark.createDataFrame([(3 * 10**18, 10**13)], "a long, n long")
    exact = F.lit(1000).cast("decimal(38,0)") * F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")
    got = words.withColumn("top", exact.cast("decimal(38,0)")).withColumn("under", (F.lit(3) * F.col("a").cast("decimal(19,0)")))
    assert got.selectExpr("top div under").first()[0] == 1000 * 10**13 // 3


def test_trie_holds_what_was_added():
    import numpy as np
    rnd = np.random.default_rng(1)
    trie, want = phrases.BurstTrie(4, burst=8), collections.Counter()
    for _ in range(5):
        rows = rnd.integers(1, 5, (300, 5)).astype("u4")
        trie.add(rows)
        want.update(map(tuple, rows.tolist()))
    assert trie.size == len(want) and any(isinstance(c, phrases.Inner) for c in trie.root.values())
    rows, counts = trie.take(100)
    assert trie.size <= 100 and len({r[0] for r in rows.tolist()} & set(trie.root)) == 0  # whole subtrees
    more, others = trie.take(0)
    got = dict(zip(map(tuple, [*rows.tolist(), *more.tolist()]), [*counts.tolist(), *others.tolist()]))
    assert got == want and trie.size == 0


# ---- byte pairs

def library():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(registered.vocabulary())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


ODD = ["", " ", None, "don't I'LL we've it'S 'S", "a<|endoftext|>b <|ENDOFTEXT|>", "İstanbul ǅ ΟΔΟΣ Σας", "éÀ Å ȺȾ ŉ ſ µªº ½²", "x" * 5000, "ab" * 3000 + ".!?" * 50,
       "日本 🎉 12３", "q\x85z\x1cq\x0bw\xa0k​", "\x00\x01", "a\tb\r\nc", "'s's't'", "Ünïcödé|'ve"]


def test_ids_and_texts_equal_the_library(spark):
    rnd = random.Random(2)
    drawn = ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0, 0x250), rnd.randrange(0x250, 0xd7ff)])) for _ in range(50)) for _ in range(200)]
    drawn += ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(1, 40))) for _ in range(500)]
    rows = [(i, t) for i, t in enumerate(ODD + drawn)] + [(None, "twice"), (None, "twice")]
    docs = spark.createDataFrame(rows, "ids long, text string").withColumn("_ids", F.lit(0))
    found = bpe.encode(docs, registered.vocabulary(), decoded="back")
    assert found.columns == ["ids", "text", "_ids", "__ids", "back"]
    tokenizer, got = library(), found.collect()
    assert len(got) == len(rows)
    for row in got:
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids
        assert row["__ids"] == ids and row.back == tokenizer.decode(ids, skip_special_tokens=False)
    again = bpe.decode(found, registered.vocabulary(), ids="__ids", text="again")
    assert again.where("back <> again").count() == 0
    assert bpe.encode(docs.limit(0), registered.vocabulary()).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs, registered.vocabulary(), ids="text")


def test_forgetting_words_changes_nothing():
    words = bpe.Vocabulary(registered.vocabulary(), words=50)
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choice("abcde") for _ in range(rnd.randrange(1, 9))) for _ in range(40)) for _ in range(50)]
    tokenizer = library()
    for text in texts:
        ids, starts = words.encode([text, text])
        assert ids[:starts[1]].tolist() == ids[starts[1]:].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_document_as_the_library(spark, sf):
    tokenizer = library()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for row in registered.QUERIES["op12_byte_pair_queue"](spark, sf).collect():
        ids = tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


# ---- conversations

STEPS, NEXT = {(0, 0): 2, (0, 2): 1, (1, 0): 2, (2, 1): 3, (3, 0): 2}, {0: 2, 1: 2, 2: 3, 3: 2}


def plain_repair(codes):
    """Least (cost, audit) by a uniform-cost search over rows and states."""
    queue, done = [(0, "", 0, 0)], set()
    while queue:
        cost, audit, i, q = heapq.heappop(queue)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(codes) and q in (0, 3):
            return cost, audit
        heapq.heappush(queue, (cost + 5, audit + "I", i, NEXT[q]))
        if i < len(codes):
            role, fault = codes[i] & 3, codes[i] >> 2
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, q))
            if fault in (0, 3):
                extra = 5 * (fault == 3)
                if (q, role) in STEPS:
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, STEPS[q, role]))
                heapq.heappush(queue, (cost + extra + 1, audit + "R", i + 1, NEXT[q]))


def test_cheapest_edits_by_brute_force():
    rnd = random.Random(4)
    for _ in range(1500):
        codes = bytes(rnd.choice([j % 2, 0, 1, 2, 3]) | 4 * rnd.choice([0, 0, 0, 1, 2, 3]) for j in range(rnd.randrange(0, 30)))
        for block in (1, 3, 64):
            assert dialogue.cheapest(codes, block) == plain_repair(codes)


def test_long_conversations_are_searched_in_blocks():
    rnd = random.Random(6)
    for codes in (bytes(3000), bytes(rnd.randrange(16) for _ in range(3000)), bytes([1, 0] * 1500)):
        cost, audit = dialogue.cheapest(codes)
        assert (cost, audit) == plain_repair(codes)


def plain_conversations(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, turns) of damaged rows per conversation."""
    said = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        said[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, turns in said.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
        codes, seen = [], set()
        for _, role, text in turns:
            spoken = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not spoken else 2 if (role, text) in seen else 3 if spoken[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append({"u": 0, "a": 1, "s": 2}.get(role[:1], 3) | 4 * fault)
        numbers = [t[0] for t in turns if t[0] is not None]
        cost, audit = plain_repair(codes)
        state, left, repaired = 0, iter(turns), []
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(left)
            if edit == "D":
                continue
            state = STEPS[state, {"u": 0, "a": 1, "s": 2}[role[:1]]] if edit == "K" else NEXT[state]
            repaired.append((role if edit == "K" else "user" if state == 2 else "assistant", text))
        faults = collections.Counter(c >> 2 for c in codes)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        out[conv] = (gaps, faults[1], faults[2], faults[3], illegal, cost, audit, repaired)
    return out


def test_conversations_by_brute_force(spark, sf, tmp_path):
    rnd = random.Random(8)
    texts = ["Yes.", "No!", "so", "", " \n", None, "Why?\n", "a.b", "Yes.", "é?", "x" * 100_000]
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, *range(9), -5, 10**12]), rnd.choice(["user", "assistant", "system", "tool", "", None]),
             rnd.choice(texts)) for _ in range(400)]
    rows += [(77, 3, "user", "Same.")] * 50 + [(78, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("cost", F.lit(1)).withColumn("plan", F.lit("x"))
    frame.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in registered.QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    want = plain_conversations(rows)
    assert set(got) == set(want)
    for conv, (*figures, turns) in want.items():
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in turns).encode()).hexdigest()
        assert got[conv] == (*figures, digest)
    damaged = dialogue.damage(frame)
    turns = collections.defaultdict(list)
    for r in dialogue.repaired_turns(damaged, dialogue.plan(damaged)).orderBy("conv_id", "place").collect():
        assert r.place == len(turns[r.conv_id])
        turns[r.conv_id].append((r.role, r.text))
    assert turns == {c: w[-1] for c, w in want.items() if w[-1]}


def test_conversations_without_rows(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert dialogue.with_digest(empty, dialogue.plan(empty)).count() == 0
    ids = spark.createDataFrame([("a",), (None,), ("a",)], "id string")
    got = sorted(map(tuple, dialogue.with_digest(empty, dialogue.plan(empty, ids)).collect()), key=str)
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == [("a", 0, 0, 0, 0, 0, 0, "", nothing), (None, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_decoding_empty_lists():
    words = bpe.Vocabulary(registered.vocabulary())
    assert words.decode(pa.array([], pa.int32()), [0, 0]).to_pylist() == [""]


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
def test_same_as_sql(spark, sf, name):
    import duckdb
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = con.sql(registered.ORACLES[name])
    got = registered.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
