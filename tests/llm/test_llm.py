"""The operators against brute force, round trips and held-out rows, and on awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsledger.llm import digest, language, lattice, mixing, packing, registered, simhash, superkmer, toxicity, trainorder, urlrules
from obsledger.llm.components import components
from obsledger.llm.tokens import encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, sequence_id string, component_id string, size string"


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "x", "y", "z") for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    """Null, empty and long texts, null ids, languages and sources, repeated rows, copies."""
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one two three", "en", "b"),
            (5, long, "de", "b"), (6, long, "de", None), (7, "one two three", None, "a"), (7, "one two three", None, "a"),
            (None, "no id here at all", "fr", "c"), (8, "É ünï \u00a0 <|endoftext|> 漢字", "fr", "c"), (9, "x" * 5000, "en", "c")]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


@pytest.fixture(scope="module")
def real(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def roots(ids, linked):
    """Least id reachable, by brute force."""
    at = {i: i for i in ids}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for a, b in linked:
        x, y = find(a), find(b)
        at[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


# --- packing -----------------------------------------------------------------

def test_ids_equal_the_tokenizer(real):
    e = encoder(registered.vocabulary())
    texts = [r.text for r in real.select("text").collect()] + ["", "İstanbul don't I'LL a\x85b\u3000c\x1cd ß.. ;;", "café café Σς"]
    want = [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == want


def packed_rightly(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_round_trip(real):
    rows = packing.pack_documents(real, registered.vocabulary()).collect()
    ids = encoder(registered.vocabulary()).encode([r.text for r in real.orderBy("doc_id").collect()])
    for n, raw in enumerate(ids):
        raw += bytes(4)
        own = sorted((r for r in rows if r.doc_id == n), key=lambda r: r.piece)
        assert [r.length for r in own] == [len(raw[a:a + 8192]) // 4 for a in range(0, len(raw), 8192)]
        assert [r.ids_crc32 for r in own] == [zlib.crc32(raw[a:a + 8192]) for a in range(0, len(raw), 8192)]
    assert packed_rightly(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_exchange_fills_gaps(spark):
    random.seed(3)
    sizes = [random.randint(300, 700) for _ in range(600)]
    items = spark.createDataFrame([(i, 0, s, "x") for i, s in enumerate(sizes)], "doc_id long, piece int, length long, offset string")
    n = [packed_rightly(packing.pack(items, 1000, group_rows=g, rounds=r).collect(), 1000) for g, r in ((30, 0), (30, 4), (10_000, 0))]
    assert n[2] <= n[1] < n[0]
    counts = np.bincount(sizes, minlength=1001)
    assert packing.lower_bound(counts, 1000) <= n[2]


def test_bound_beats_the_sum():
    counts = np.zeros(101, int)
    counts[51], counts[34] = 10, 0
    assert packing.lower_bound(counts, 100) == 10  # two of 51 never share
    counts[:] = 0
    counts[34] = 9
    assert packing.lower_bound(counts, 100) == 5  # at most two of 34 each


def test_packing_awkward(awkward, nothing):
    rows = packing.pack_documents(awkward, registered.vocabulary()).collect()
    assert sorted(r.length for r in rows if r.doc_id in (1, 2, 3)) == [1, 1, 1]
    assert len([r for r in rows if r.doc_id == 7]) == 2 and [r for r in rows if r.doc_id is None]
    packed_rightly(rows, 2048)
    assert packing.pack_documents(nothing, registered.vocabulary()).count() == 0


# --- near duplicates -----------------------------------------------------------

def test_components(spark):
    random.seed(1)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    want = roots({x for p in pairs for x in p}, pairs)
    assert {i: got.get(i, i) for i in want} == want


def test_simhash_fingerprint_by_the_letter():
    import re

    import xxhash
    text = "The Quick\tbrown  fox\njumps OVER the lazy DOG É é"
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(text.encode()) == [want]
    assert simhash.fingerprint(b"Two words") == [xxhash.xxh64_intdigest(b"two words", 42)]
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == [0]


@pytest.mark.parametrize("bucket", [4000, 2])
@pytest.mark.parametrize("distance", [2, 5])
def test_simhash_links_all_within_the_distance(spark, bucket, distance):
    random.seed(2)
    values = {random.getrandbits(64) for _ in range(150)}
    for b in list(values)[:30]:
        for _ in range(10):
            v = b
            for _ in range(random.randint(1, 4)):
                v ^= 1 << random.randrange(64)
            values.add(v)
    values = list(values)
    nodes = spark.createDataFrame([(i, simhash.signed(v)) for i, v in enumerate(values)], "node long, f0 long")
    got = {r.node: r.root for r in components(simhash.near_links(nodes, 1, distance, distance, bucket), "a", "b").collect()}
    linked = [(i, j) for i, v in enumerate(values) for j in range(i) if (v ^ values[j]).bit_count() <= distance]
    want = roots(range(len(values)), linked)
    assert {i: got.get(i, i) for i in want} == want


def test_simhash_awkward(spark, awkward, nothing):
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(awkward).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (7, 4), (5, 5), (6, 5), (None, None)} <= got
    kept = simhash.deduplicate(awkward)
    assert kept.columns == awkward.columns and kept.count() == len({c for _, c in got})
    assert simhash.near_duplicates(nothing).count() == simhash.deduplicate(nothing).count() == 0


def test_near_copies_go_and_others_stay(spark):
    random.seed(5)
    words = [f"word{k}" for k in range(3000)]
    texts = [[random.choice(words) for _ in range(200)] for _ in range(40)]
    near = [t[:100] + [random.choice(words)] + t[101:] for t in texts[:20]]
    docs = docs_of(spark, [(i, " ".join(t), "en", "a") for i, t in enumerate(texts + near)])
    kept = {r.doc_id for r in simhash.deduplicate(docs, shingle=5, words=4, distance=4, most=42).collect()}
    assert set(range(40)) <= kept and len(kept) <= 41


def planted_prints(pairs, seed=0):
    """Fingerprints of ``pairs`` pairs with bits apart as at Jaccard 0.8, signed; row k belongs to row pairs + k."""
    rng = np.random.default_rng(seed)
    one = rng.random((pairs, 256)) < 0.5
    both = np.concatenate([one, one ^ (rng.random((pairs, 256)) < simhash.apart(0.8))])
    return np.packbits(both, axis=1).view(">i8").astype(np.int64)


def test_parts_reach_pairs_at_the_threshold(spark):
    parts = simhash.fixed_parts(4)
    assert simhash.recall(0.8, parts) >= 0.99 and all(len(set(p)) == 12 for p in parts.tolist())
    rows = planted_prints(1500).tolist()
    nodes = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "node long, f0 long, f1 long, f2 long, f3 long")
    links = {(min(r), max(r)) for r in simhash.fixed_links(nodes, 4, simhash.bit_limit(0.8, 4), 4000).collect()}
    assert len(links) >= 0.99 * 1500 and all(b == a + 1500 for a, b in links)


def test_a_pair_meets_whatever_the_other_rows_are(spark):
    rows, names = planted_prints(400).tolist(), "node long, f0 long, f1 long, f2 long, f3 long"
    rng = np.random.default_rng(9)
    skewed = np.packbits(rng.random((6000, 256)) < 0.2, axis=1).view(">i8").astype(np.int64).tolist()
    few = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], names)
    many = spark.createDataFrame([(k, *r) for k, r in enumerate(rows + skewed)], names)
    found = [{(min(r), max(r)) for r in simhash.fixed_links(f, 4, 42, b).collect() if max(r) < 800 and r.a != r.b} for f, b in ((few, 4000), (many, 4000), (many, 30))]
    assert found[0] and found[0] == found[1] == found[2]


def shingle_sets(texts, k=5):
    def of(t):
        w = t.lower().split()
        return {" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    return [of(t) for t in texts]


def test_repeated_lines_do_not_link(spark):
    random.seed(11)
    texts, line = [], " ".join(f"line{k}" for k in range(12))
    for times in (10, 20, 40):
        texts += [" ".join([f"w{random.getrandbits(40)}" for _ in range(200)] + [line] * times) for _ in range(4)]
    sets = shingle_sets(texts)
    assert all(len(a & b) < 0.1 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    docs = docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    assert {r.doc_id for r in simhash.deduplicate(docs, shingle=5, words=4, least=0.8).collect()} == set(range(len(texts)))


@pytest.mark.parametrize("bucket, others", [(4000, 0), (8, 3000)])
def test_near_duplicates_by_exact_jaccard(spark, bucket, others):
    random.seed(21)
    fresh, line = lambda n: [f"w{random.getrandbits(40)}" for _ in range(n)], " ".join(f"line{k}" for k in range(12))
    texts = []
    for share in np.linspace(0.6, 0.95, 71):  # one changed tail each; shared shingles c of 300 make c / (600 - c)
        one, common = fresh(304), round(600 * share / (1 + share))
        texts += [one, one[:common + 4] + fresh(300 - common)]
    for _ in range(10):  # chains: neighbours near, ends far
        chain = [fresh(304)]
        for k in range(3):
            chain.append(chain[-1][28:] + fresh(28))
        texts += chain
    hot = fresh(304)
    texts += [hot[:k] + fresh(1) + hot[k + 1:] for k in range(5, 300, 6)]
    texts += [fresh(150) + line.split() * 20 for _ in range(10)] + [fresh(200) for _ in range(10)]
    texts = [" ".join(t) for t in texts]
    sets = shingle_sets(texts)
    linked = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if len(a & b) >= 0.8 * len(a | b)]
    want = roots(range(len(texts)), linked)
    docs = docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts + [" ".join(fresh(30)) for _ in range(others)])])
    rows = simhash.near_duplicates(docs, shingle=5, words=4, least=0.8, bucket_rows=bucket).collect()
    got = {r.doc_id: r.component_id for r in rows}
    assert len(got) == len(texts) + others and all(got[i] == i for i in range(len(texts), len(got)))
    assert all(got[got[i]] == got[i] and want[got[i]] == want[i] for i in want)  # no false merge
    assert sum(got[i] != want[i] for i in want) <= 1  # 99.8 % of pairs at 0.8 meet
    if bucket == 4000:
        assert {r.doc_id for r in simhash.deduplicate(docs, shingle=5, words=4, least=0.8).collect()} == set(got.values())


def test_near_duplicate_stage_by_brute_force(spark):
    import corpus_pipeline as pipeline
    random.seed(31)
    texts = [" ".join(random.choice("the of and sea cat dog sky".split()) for _ in range(random.randrange(0, 60))) for _ in range(150)]
    for text in texts[:60]:
        words = text.split() + ["tail"]
        at = random.randrange(len(words))
        texts += [" ".join(words[:at] + ["changed"] + words[at + 1:]), text.upper(), f" {text}\n"]
    prints = [simhash.fingerprint(t.encode())[0] for t in texts]
    linked = [(i, j) for i, f in enumerate(prints) for j in range(i) if (f ^ prints[j]).bit_count() <= 2]
    want = roots(range(len(texts)), linked)
    docs = docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    kept = pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 2, (400, 8))
    own, around = lattice.nearest_e8(x), lattice.neighbours()
    assert around.shape == (240, 8) and np.allclose((around ** 2).sum(axis=1), 2)
    best = ((x - own) ** 2).sum(axis=1)
    assert all((((x - own - v) ** 2).sum(axis=1) >= best - 1e-9).all() for v in around) and best.max() <= 1 + 1e-9


@pytest.mark.parametrize("cell", [4000, 5])
def test_lattice_recall(spark, cell):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 32))
    rows = [b + rng.normal(0, 0.05 if k < 60 else 0.25, 32) for k, b in enumerate(base) for _ in range(6)] + [base[0]] * 4
    vectors = np.array(rows, np.float32).astype(float)
    labels = [int(k) % 3 for k in range(len(vectors))]
    frame = spark.createDataFrame([(k, v.tolist(), labels[k]) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = (unit @ unit.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels))
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in lattice.near_vectors(frame, cell_rows=cell).collect()}
    links = np.array([got[k].n_links for k in range(len(vectors))])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.98 * near.sum()
    want = roots(range(len(vectors)), zip(*np.nonzero(near)))
    assert np.mean([got[k].component_id == want[k] for k in want]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_lattice_awkward(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 0, "x"), (2, [0.0, 0.0], 0, "x"), (3, [1.0, None], 0, "x"), (4, [nan, 1.0], 0, "x"), (5, [inf, 1.0], 0, "x"), (6, [], 0, "x"),
            (7, [1.0, 2.0], None, "x"), (8, [1.0, 2.0], 0, "x"), (9, [1.0, 2.0], 0, "x"), (9, [1.0, 2.0], 0, "x"), (10, [1.0, 2.0, 0.0], 0, "x"), (11, [1e200, 2e200], 0, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(frame).collect())
    assert got == [(i, 0, i, True) for i in range(1, 8)] + [(8, 3, 8, True), (9, 3, 8, False), (9, 3, 8, False), (10, 0, 10, True), (11, 3, 8, False)]
    assert lattice.near_vectors(frame.limit(0)).count() == 0


# --- repeated windows ------------------------------------------------------------

def brute_windows(rows, k=20):
    seen, out = set(), {}
    for i, t in sorted(rows):
        w, gone = (t or "").encode().split(), set()
        for s in range(len(w) - k + 1):
            key = b" ".join(w[s:s + k])
            if key in seen:
                gone.update(range(s, s + k))
            seen.add(key)
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_super_kmers_by_brute_force(spark, real):
    random.seed(1)
    voc = [f"w{i}" for i in range(40)]
    passages = [[random.choice(voc) for _ in range(n)] for n in (10, 25, 60, 120)]
    rows = []
    for i in range(200):
        w = []
        for _ in range(random.randint(0, 5)):
            w += random.choice(passages) if random.random() < 0.5 else [random.choice(voc) for _ in range(random.randint(1, 60))]
        rows.append((i, " ".join(w + ["a"] * (random.randint(0, 70) if i % 7 == 0 else 0)).replace(" ", " \n" if i % 5 == 0 else " ")))
    for data in (rows, [(r.doc_id, r.text) for r in real.collect()]):
        frame = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
        got = {r.other.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in superkmer.remove_repeats(
            frame, bucket_bytes=20_000, shard_bytes=30_000).collect()}
        assert got == brute_windows(data)


def test_super_kmer_awkward(awkward, nothing):
    out = superkmer.without_repeats(awkward, n_chars="n_chars")
    assert out.columns == awkward.columns and out.count() == awkward.count()
    by = {r.doc_id: r for r in out.collect()}
    assert by[1].text is None and by[2].text == "" and by[3].text == " \n\t " and by[6].text == "" and by[6].n_chars == 0
    assert by[4].text == "one two three" and len(by[5].text.split()) >= 977
    assert superkmer.without_repeats(nothing).count() == 0


# --- toxicity, language, urls ------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    random.seed(4)
    clean, bad = [f"c{k}lean" for k in range(400)], ["vileword", "nastyone", "grimterm"]
    rows, labels = [], []
    for i in range(1200):
        hits = random.choice([1, 2, 8]) if i % 6 == 0 else 0
        w = [random.choice(clean) for _ in range(80)] + [random.choice(bad) for _ in range(hits)]
        random.shuffle(w)
        rows.append((i, " ".join(w).capitalize(), "en", "a"))
        labels.append((i, 1, int(hits > 0)))
    docs = docs_of(spark, rows)
    known = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, quality int, toxic int")
    known = known.union(spark.createDataFrame([(None, 1, 1), (3, 1, None)], known.schema))
    labels2 = spark.createDataFrame(labels, known.schema).where("doc_id % 4 = 0 OR doc_id % 2 = 1").union(known)
    model = toxicity.fit(docs, labels2)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [x for x in labels if x[0] % 4 == 2]
    assert all(got[i].rejected == bool(t) for i, _, t in held)
    assert toxicity.without_toxic(docs, model).count() == 1000
    many = [got[i].severity for i, t, *_ in rows if sum(t.lower().count(b) for b in bad) >= 8]
    one = [got[i].severity for i, t, *_ in rows if sum(t.lower().count(b) for b in bad) == 1]
    assert min(many) > max(one)


def test_toxicity_awkward(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(awkward, none)
    assert toxicity.without_toxic(awkward, model).count() == awkward.count()
    assert {(r.severity, r.rejected) for r in toxicity.score(awkward, model).collect()} == {(0.0, False)}
    one = spark.createDataFrame([(4, 0, 1), (5, 1, 0), (1, 1, 1)], none.schema)
    assert toxicity.score(awkward, toxicity.fit(awkward, one)).count() == awkward.count()
    assert toxicity.score(nothing, toxicity.fit(nothing, one)).count() == 0


def test_language_on_held_out_rows(real, awkward, nothing):
    learned = language.learn(real)
    rows = language.identify(real, learned).join(real.select("doc_id", F.col("lang").alias("truth")), "doc_id").where(
        language.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 30 and np.mean([r.lang_pred == r.truth for r in rows]) >= 0.9
    assert all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r.lang_pred for r in language.identify(awkward, learned).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and got[4] in learned
    assert language.learn(nothing) == {} and language.identify(nothing, learned).count() == 0
    assert {r.lang_pred for r in language.identify(awkward, {}).collect()} == {"und"}
    assert set(language.learn(awkward)) <= {"en", "de", "fr"}


def test_urls_by_rule(spark):
    urls = ["http://a.example.NET/en/1?x", "http://net/x", "http://org/fr/", "https://m.example.com/de/9#t", "http://example.com/deep",
            "http://badnet/de/", None, "no address", "http://x.net", "ftp://HOST:80?q=/net/", "http://my.org/fr", "s://u.org/fr/a#b"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("verdict", F.lit("x"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, none, registered.RULES).collect()}
    assert got[0] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[1] == ("net", "/x", "net/", "block")
    assert got[2] == ("org", "/fr/", "org/fr/", "allow") and got[3][2:] == ("example.com/de/", "block")
    assert got[4][2:] == got[5][2:] == (None, "allow") and got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("x.net", "", None, "allow") and got[9] == ("host:80", "", None, "allow")
    assert got[10][2] is None and got[11] == ("u.org", "/fr/a", "org/fr/", "allow")
    assert urlrules.judge(pages.limit(0), none, registered.RULES).count() == 0


def test_urls_by_mined_rules(spark):
    pages = [(k, f"https://{'ads' if k % 4 == 0 else 'www'}.site{k % 3}.io/{'promo' if k % 2 == 0 else 'news'}/{k}") for k in range(600)]
    labels = [(k, 1, int(k % 4 == 0)) for k in range(300)] + [(None, 1, 1), (299, None, None)]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.page_id: r.verdict for r in urlrules.judge(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), [], confidence=0.9).collect()}
    assert all(got[k] == ("block" if k % 4 == 0 else "allow") for k in got) and len(got) == 600
    rows = spark.createDataFrame([(0, ["a", "b", "c"]), (1, ["a"]), (2, ["a", "b", "c"]), (3, [])], "row long, items array<string>")
    rules = spark.createDataFrame([(7, ["a"]), (8, ["b", "c"]), (9, ["b", "z"])], "rule_id long, tokens array<string>")
    assert sorted(map(tuple, urlrules.matches(rows, rules, "items").collect())) == [(0, 7), (0, 8), (1, 7), (2, 7), (2, 8)]


# --- order and digests ---------------------------------------------------------------

def test_training_order_round_trip(real, awkward, nothing, tmp_path):
    folder = f"file://{tmp_path}/a"
    rows = sorted(trainorder.write_in_order(real, registered.vocabulary(), folder, most=100, shard_bytes=20_000).collect(), key=lambda r: r.slot)
    read = list(trainorder.read_from(folder, most=100))
    assert [r.slot for r in rows] == list(range(len(rows))) and len({r.shard for r in rows}) > 3
    assert [(r.slot, r.doc_id, r.piece, r.ids_crc32) for r in rows] == [
        (s, d, p, zlib.crc32(np.array(x, "<u4").tobytes())) for s, d, p, x in read]
    assert list(trainorder.read_from(folder, 333, most=100)) == read[333:]
    odd = trainorder.write_in_order(awkward, registered.vocabulary(), f"file://{tmp_path}/b").collect()
    assert sorted(r.slot for r in odd) == list(range(len(odd))) and {r.doc_id for r in odd} == {*range(1, 10), None}
    assert trainorder.write_in_order(nothing, registered.vocabulary(), f"file://{tmp_path}/c").count() == 0


def test_feistel_is_a_permutation():
    for n in (1, 2, 5, 1000, 4097):
        x = trainorder.permute(np.arange(n), n, 9)
        assert sorted(x.tolist()) == list(range(n)) and (trainorder.permute(x, n, 9, back=True) == np.arange(n)).all()


def test_entropy_levels_by_brute_force():
    import math
    random.seed(6)
    raw = bytes(random.choice(b"abcde  \n") for _ in range(300)) + b"z" * 100
    got = digest.levels(np.frombuffer(raw, np.uint8))
    for s in range(len(raw) - 63):
        w = raw[s:s + 64]
        h = -sum(w.count(c) / 64 * math.log2(w.count(c) / 64) for c in set(w))
        assert abs(got[s] - h / 6 * digest.LEVELS) <= 1.01


@pytest.mark.parametrize("part", [8 << 20, 20_000])
def test_digest_of_edited_texts(real, part):
    rows = {r.doc_id: r for r in digest.edited_pairs(real, part_bytes=part).collect()}
    docs = sorted(((r.doc_id, r.text) for r in real.collect()), reverse=True)
    for (i, a), (j, b) in zip(docs, docs[1:] + docs[:1]):
        k = len(a) // 3
        assert rows[i].n_chars == len(a) and rows[i].edited_sha256 == hashlib.sha256((a[:len(a) - k] + b[:k]).encode()).hexdigest()
        assert rows[i].near_next == digest.likeness([bytes.fromhex(rows[i].fingerprint)], [bytes.fromhex(rows[j].fingerprint)])[0]
    by = {}
    for i, t in docs:
        assert by.setdefault(t, rows[i].fingerprint) == rows[i].fingerprint
    edited, following = np.array([(r.near_edited, r.near_next) for r in rows.values()]).T
    assert (edited > following).mean() > 0.9 and edited.min() >= 0 and edited.max() <= 1


def test_digest_awkward(spark, awkward, nothing):
    rows = digest.edited_pairs(awkward).collect()
    assert len(rows) == awkward.count() and {r.fingerprint for r in rows if r.doc_id in (1, 2)} == {""}
    assert len({r.fingerprint for r in rows if r.doc_id in (5, 6)}) == 1
    assert digest.edited_pairs(nothing).count() == 0
    (alone,) = digest.edited_pairs(docs_of(spark, [(5, "abc", None, None)])).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"aba").hexdigest() and alone.near_next == 1.0
    parts = np.random.default_rng(0).bytes(90_000)
    long = digest.fingerprints([parts, parts[:60_000]], np.arange(digest.LEVELS + 1))
    assert len(long[0]) > 256 and digest.likeness(long[:1], long[1:])[0] > 0.7


def test_short_texts_keep_features():
    random.seed(8)
    rank = np.arange(digest.LEVELS + 1)
    for size in (8, 12, 20, 30, 50, 63, 64, 80, 95, 96, 150, 300, 511, 530):
        texts = ["".join(random.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(size)).encode() for _ in range(60)]
        edited = [a[:size - size // 3] + b[:size // 3] for a, b in zip(texts, texts[1:] + texts[:1])]
        one, two = digest.fingerprints(texts, rank), digest.fingerprints(edited, rank)
        near, other = digest.likeness(one, two), digest.likeness(one, one[2:] + one[:2])
        assert min(near) > 0.1 and np.mean(near) > 0.35 and np.mean(other) < 0.1, (size, min(near), np.mean(near), np.mean(other))


# --- mixing and the pipeline -----------------------------------------------------------

def brute_targets(sizes, weights, share, most):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    got, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        unit = left / sum(w[s] for s in free)
        for s in free:
            got[s] += unit * w[s]
        left = sum(max(0.0, got[s] - most * sizes[s]) for s in free)
        got = {s: min(v, most * sizes[s]) for s, v in got.items()}
        free = {s for s in free if got[s] < most * sizes[s]}
    return got


def test_mixing_targets_and_rows(spark, real):
    odd = real.withColumn("source", F.when(F.col("source") != "src3", F.col("source")))
    found, name = mixing.mix(odd, block_words=500, shard_blocks=8)
    rows = found.collect()
    words = {}
    for r in rows:
        assert r.size == len((r.text or "").encode().split())
        words[r.source] = words.get(r.source, 0) + r.size
    want = brute_targets(words, (3.0, 1.0, 2.0), 1.5, 2.0)
    for s in words:
        own = [r for r in rows if r.source == s]
        assert abs(own[0].target - want[s]) < 1e-6 * max(1, want[s]) and own[0].source_size == words[s]
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r.size for r in own) / 2 + 1
    assert all(r.taken <= 2 * r.size and len(r.shards) == r.copies and r.taken == r.size * r.copies for r in rows)
    assert sorted(map(str, mixing.mix(odd.repartition(7), block_words=500, shard_blocks=8)[0].collect())) == sorted(map(str, rows))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quota_tree():
    blocks = {0: 100, 1: 7, 2: 33, 3: 0}
    out = mixing.split_quotas(blocks, 9, seed=3)
    for s, n in blocks.items():
        assert sum(q for t, _, q in out if t == s) == n
    per = [sum(q for _, k, q in out if k == shard) for shard in range(9)]
    assert max(per) - min(per) <= 1 and out == mixing.split_quotas(blocks, 9, seed=3)


def test_mixing_awkward(awkward, nothing):
    found, name = mixing.mix(awkward)
    assert found.count() == awkward.count() and name["size"] == "_size" and set(awkward.columns) <= set(found.columns)
    assert mixing.mixed_rows(awkward).columns == awkward.columns
    assert mixing.mix(nothing)[0].count() == mixing.mixed_rows(nothing).count() == 0


def test_mixing_keeps_columns_of_any_name(awkward):
    names = ["_s", "_p", "_no0", "_block0", "_shard0", "_at1", "_of", "_slot", "_u", "_run"]
    odd = awkward.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names) if n not in awkward.columns])
    found, name = mixing.mix(odd)
    plain, other = mixing.mix(awkward)
    assert found.columns[:len(odd.columns)] == odd.columns
    assert sorted(r[0] for r in found.select(name["taken"]).collect()) == sorted(r[0] for r in plain.select(other["taken"]).collect())
    assert mixing.mixed_rows(odd).columns == odd.columns


def test_pipeline(spark, sf, awkward, nothing):
    import corpus_pipeline as pipeline
    rows = pipeline.run(spark, sf).collect()
    assert rows and packed_rightly(rows, 2048)
    for docs in (awkward, nothing, awkward.select("doc_id", "text", "source")):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
        assert pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()


def test_queries_are_registered(spark):
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 11)) and "pipeline" in names
