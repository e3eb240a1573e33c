"""Every operator against a plain version, over a table of the test data and over a table of edge cases."""

import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from tallyworks.llm import (
    bpe,
    jaccard,
    library_tokens,
    packing,
    pii,
    preferences,
    prints,
    projection_forest,
    quality_rules,
    rule_ensemble,
    statistics,
    suffix_dedup,
    token_files,
)
from tallyworks.llm.queries import ORACLES, QUERIES
from tests.compare import connect, spark_rows, sql_rows
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "One two three"),
    (5, "one TWO three"),
    (6, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf again"),
    (7, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf again"),
    (8, LONG),
    (9, LONG + " one more word at the end"),
    (10, "Ünïcode – ß 中文 a<|endoftext|>b a.b@c.de 1.2.3.4 and 4387 5130 3523 7269 and +1 (456) 555-2186 or (456) 555-2186"),
    (11, "= " * 500 + "=" * 500),
]
# Repeated rows, and columns whose names clash with those that operators use inside.
CLASHES = ("anchor", "score", "n_words", "ids", "entities", "kept", "shard", "near", "entry", "start")


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(k, text, *(["x"] * len(CLASHES))) for k, text in EDGES]
    names = ", ".join(f"{name} string" for name in CLASHES)
    return spark.createDataFrame(rows + rows[3:6], f"doc_id long, text string, {names}")


@pytest.fixture(scope="module")
def nothing(spark, edges):
    return edges.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return {row.doc_id: row.text for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(bpe.vocabulary("word_bpe_49k.json"))


def test_every_dealt_query_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")) == list(range(1, 14))
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    got = spark_rows(QUERIES[name](spark, FOLDER))
    assert got == sql_rows(connect(FOLDER), ORACLES[name])
    assert got[1]


def test_quality_rules_edges(edges, nothing):
    rows = quality_rules.judge(edges).select("doc_id", "n_words", "n_repeat_words", "base_failed", "kept").collect()
    assert len(rows) == len(EDGES) + 3
    found = {row.doc_id: row for row in rows}
    assert found[1].n_words == found[2].n_words == found[3].n_words == 0
    assert found[1].base_failed and not found[1].kept
    assert found[8].n_words == 20_000 and found[8].n_repeat_words == 0
    assert found[11].n_words == 501 and found[11].n_repeat_words == 500
    assert quality_rules.judge(nothing).count() == 0


def test_rule_ensemble(spark, edges, nothing):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id < 3000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").filter("doc_id < 3000")
    ensemble = rule_ensemble.train(documents, labels)
    assert ensemble.weighted
    scored = rule_ensemble.predict(documents.select("doc_id", "text"), ensemble).withColumn("out", rule_ensemble.held_out("doc_id"))
    rows = scored.join(labels, "doc_id").filter("out").collect()
    good = [row.score for row in rows if row.quality == 1]
    bad = [row.score for row in rows if row.quality == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.98
    assert all(0 <= row.score <= 1 for row in rows)
    assert rule_ensemble.predict(edges.select("doc_id", "text"), ensemble).count() == len(EDGES) + 3
    assert rule_ensemble.predict(nothing.select("doc_id", "text"), ensemble).count() == 0
    assert not rule_ensemble.train(documents, labels.limit(0)).weighted


def test_rules_equal_plain_ones(spark, docs, edges):
    """The registered query against the rules of the same ensemble, applied to plainly counted statistics."""
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    ensemble = rule_ensemble.train(read("documents"), read("labels"))
    assert ensemble.weighted and all(rule.bounds for rule, _ in ensemble.weighted)
    forms = {form for word in statistics.stop_words() for form in (word, word.capitalize())}

    def score(text):
        found = brute.quality_statistics(text or "", forms)
        assert set(found) == set(rule_ensemble.FEATURES)
        held = (all((found[f] > t) == above for f, above, t in rule.bounds) for rule, _ in ensemble.weighted)
        return 1 / (1 + math.exp(-ensemble.intercept - sum(w for (_, w), holds in zip(ensemble.weighted, held) if holds)))

    rows = QUERIES["op1_rule_ensemble"](spark, FOLDER).collect()
    assert sorted(row.doc_id for row in rows) == sorted(docs)
    for row in rows:
        assert row.score == pytest.approx(score(docs[row.doc_id]), abs=1e-12)
        assert row.predicted == (row.score >= 0.5) and row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
    # Columns of the input with the names of results and statistics are replaced, the others stay.
    clashing = edges.withColumns({"words": F.lit("x"), "predicted": F.lit("x")})
    rows = rule_ensemble.predict(clashing, ensemble).collect()
    assert len(rows) == len(EDGES) + 3 and all(row.anchor == "x" and row.predicted in (0, 1) for row in rows)
    for row in rows:
        assert row.score == pytest.approx(score(dict(EDGES)[row.doc_id]), abs=1e-12)


@pytest.mark.parametrize(("gathered", "ranges"), [(prints.GATHERED, 8), (50, 8), (50, 13)])
def test_frequent_hashes(spark, monkeypatch, gathered, ranges):
    """Hashes counted in few and in many ranges, sent in one and in many blocks, against plain counts."""
    monkeypatch.setattr(prints, "GATHERED", gathered)
    random = np.random.default_rng(3)
    hashes = prints.mix(np.append(random.integers(0, 3000, 6000), np.full(3000, 7)).astype(np.uint64))
    random.shuffle(hashes)
    df = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h long").repartition(5)
    take = lambda batch: batch.column("h").to_numpy().view(np.uint64)
    (twice, often), n, n_distinct = prints.frequent(df, take, [(2, 24), (1000, 20)], ranges, text=None, bounded=(False, True))
    values, counts = np.unique(hashes, return_counts=True)
    assert (n, n_distinct) == (len(hashes), len(values))
    for table, least, bits in ((twice, 2, 24), (often, 1000, 20)):
        slots = set((values[counts >= least] >> np.uint64(64 - bits)).tolist())
        assert int(np.unpackbits(np.frombuffer(table, dtype=np.uint8)).sum()) == len(slots)
        assert prints.marked(table, values[counts >= least]).all()
    empty = prints.frequent(df.limit(0), take, [(2, 20)], ranges, text=None)
    assert empty == ([bytes(1 << 17)], 0, 0)


def test_a_range_stays_small():
    """The texts of a range have at most 2**GROUP_POWER bytes at any size, until the tables have no more bits to share."""

    class Texts:
        def __init__(self, power):
            self.power = power

        def agg(self, _):
            return self

        def first(self):
            return [1 << self.power]

    for power in range(10, 48):
        bits, ranges = prints.table_sizes(Texts(power))
        assert power - ranges <= prints.GROUP_POWER and bits - ranges >= 7 and bits <= prints.MOST_BITS


def test_jaccard_join(spark, docs, edges, nothing):
    rows = QUERIES["op2_jaccard_join"](spark, FOLDER).collect()
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in rows} == brute.linked(docs)
    rows = jaccard.link_documents(edges).collect()
    assert len(rows) == len(EDGES) + 3
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in rows} == brute.linked(dict(EDGES))
    assert jaccard.link_documents(nothing).count() == 0


def test_jaccard_join_of_light_and_near_sets(spark):
    """Sets around the boundary of light and heavy ones, and copies with one or a few words changed."""
    random = np.random.default_rng(7)
    texts = []
    for size in (*range(4, 40), 60, 150):
        base = [f"w{size}_{i}" for i in range(size)]
        texts.append(" ".join(base))
        for changes in (1, 1, 2):
            near = list(base)
            for at in random.choice(len(near), changes, replace=False):
                near[at] = f"c{random.integers(1 << 30)}"
            texts += [" ".join(near), " ".join(base[:-changes])]
    table = dict(enumerate(texts))
    df = spark.createDataFrame(list(table.items()), "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(df).collect()} == brute.linked(table)


def test_light_boundary_is_by_cost():
    assert jaccard.light_boundary({n: 10 for n in range(1, 60)}, 1.0) > 0
    assert jaccard.need(13, 13) == 12 and jaccard.need(12, 12) == 12 and jaccard.least_need(20) == 17


def test_token_files(spark, docs, words, edges, nothing, tmp_path):
    found = {row.doc_id: row for row in QUERIES["op4_token_files"](spark, FOLDER).collect()}
    start = 0
    for k in sorted(docs):
        ids = words.encode(docs[k] or "", add_special_tokens=False).ids + [2]
        assert (found[k].start, found[k].n_tokens, found[k].ids_crc32) == (start, len(ids), brute.crc(ids))
        start += len(ids)
    path = bpe.vocabulary("word_bpe_49k.json")
    tokens = library_tokens.tokenize(token_files.deal(edges.select("doc_id", "text"), "doc_id", 3), path, 2)
    manifest = token_files.write_sequences(tokens, str(tmp_path / "a"), "doc_id", "ids", library_tokens.id_type(path), length=16)
    rows = token_files.read_documents(manifest).orderBy("start").collect()
    assert [row.key for row in rows] == sorted(row.key for row in rows) and len(rows) == len(EDGES) + 3
    assert [row.start for row in rows] == np.cumsum([0, *(row.n_tokens for row in rows)])[:-1].tolist()
    reader = token_files.SequenceReader(manifest.orderBy("shard").first().path + ".arrow")
    ids, mask = reader.sequence(0)
    assert len(ids) == len(mask) == 16 and mask.any()
    reader.source.seek(0)
    whole = reader.source.read_buffer()
    for part in (ids, mask):
        assert whole.address <= part.ctypes.data and part.ctypes.data + part.nbytes <= whole.address + whole.size
    tokens = library_tokens.tokenize(token_files.deal(nothing.select("doc_id", "text"), "doc_id", 3), path, 2)
    assert token_files.write_sequences(tokens, str(tmp_path / "b"), "doc_id", "ids", library_tokens.id_type(path)).count() == 0


def test_token_files_of_odd_rows(spark, words, tmp_path):
    """Null keys, a document longer than a batch of sequences, repeated rows, and columns with clashing names."""
    path, long = bpe.vocabulary("word_bpe_49k.json"), "one two three " * 3000
    rows = [(None, "left out of no file", 0, "a"), (5, long, 1, "b"), (5, long, 1, "b"), (2, "", 2, "c"), (2**60, "last", 3, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int, path string")
    tokens = library_tokens.tokenize(token_files.deal(df, "doc_id", 4), path, 2)
    manifest = token_files.write_sequences(tokens, str(tmp_path / "odd"), "doc_id", "ids", library_tokens.id_type(path), length=8)
    found = [(row.key, row.n_tokens, row.ids_crc32) for row in token_files.read_documents(manifest).orderBy("start").collect()]
    ids = {text: words.encode(text, add_special_tokens=False).ids + [2] for _, text, _, _ in rows}
    want = [(rows[at][0], len(ids[rows[at][1]]), brute.crc(ids[rows[at][1]])) for at in (0, 3, 1, 2, 4)]
    assert found == want and want[2][1] > 8 * token_files.BATCH_SEQUENCES
    assert all(row.path.startswith("file:") for row in manifest.collect())
    bounds, keys = [3, 3**20, 2**60], [None, 3, 4, 3**20, 2**60, 2**60 + 1]
    frame = spark.createDataFrame([(key,) for key in keys], "k long")
    assert [row[0] for row in frame.select(token_files._shard_of(frame.k, bounds)).collect()] == [0, 0, 1, 1, 2, 3]


def test_projection_forest(spark):
    random = np.random.default_rng(3)
    vectors = random.standard_normal((400, 8)).astype(np.float32)
    vectors[300:340] = vectors[300]
    rows = [(int(k), vector.tolist()) for k, vector in enumerate(vectors)]
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [None] + [1.0] * 7), (1004, [1.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    asked = df.filter("vec_id % 20 = 0")
    for row in projection_forest.nearest(df, asked, 20, leaf_rows=16, block=8, visited=0.6).collect():
        found.setdefault(row.query_id, {})[row.rank] = (row.vec_id, row.score)
    exact = vectors.astype(np.float64)
    hits = []
    for query, ranks in found.items():
        assert sorted(ranks) == list(range(1, 21))
        order = [ranks[k] for k in range(1, 21)]
        assert order == sorted(order, key=lambda one: (-one[1], one[0])) and query not in {one[0] for one in order}
        assert all(abs(score - exact[query] @ exact[vec]) < 1e-9 for vec, score in order)
        scores = exact @ exact[query]
        scores[query] = -np.inf
        hits.append(len(set(np.argsort(-scores, kind="stable")[:20]) & {one[0] for one in order}) / 20)
    assert set(found) == set(range(0, 400, 20)) and np.mean(hits) > 0.9
    assert projection_forest.nearest(df.limit(0), asked, 20).count() == 0


def test_packing(spark, docs, words, edges, nothing):
    def check(rows, texts, copies):
        sequences, pieces = {}, {}
        for row in rows:
            sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
            pieces.setdefault(row.doc_id, []).append(row)
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at and length > 0
                at += length
            assert at <= 4096
        for k, text in texts.items():
            ids = words.encode(text or "", add_special_tokens=False).ids + [2]
            seen = np.zeros(len(ids), dtype=int)
            for row in pieces[k]:
                part = ids[row.start : row.start + row.length]
                assert row.doc_tokens == len(ids) and brute.crc(part) == row.ids_crc32
                seen[row.start : row.start + row.length] += 1
            assert (seen == copies(k)).all()
        return sum(row.length for row in rows) / 4096 / len(sequences)

    assert check(QUERIES["op6_packing"](spark, FOLDER).collect(), docs, lambda k: 1) > 0.8
    path = bpe.vocabulary("word_bpe_49k.json")
    again = {k for k, _ in EDGES[3:6]}
    check(packing.packed_documents(edges, path, 2).collect(), dict(EDGES), lambda k: 1 + (k in again))
    assert packing.packed_documents(nothing, path, 2).count() == 0


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_suffix_dedup(spark, docs, edges, nothing, hot):
    rows = suffix_dedup.cut_repeats(spark.read.parquet(f"{FOLDER}/documents.parquet"), hot=hot).collect()
    found = {row.doc_id: (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) for row in rows}
    assert found == brute.cut(docs)
    rows = suffix_dedup.cut_repeats(edges, hot=hot).collect()
    assert len(rows) == len(EDGES) + 3
    assert {row.doc_id: (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) for row in rows} == brute.cut(dict(EDGES))
    assert suffix_dedup.cut_repeats(nothing, hot=hot).count() == 0


def test_bpe(spark, docs, edges, nothing):
    path = bpe.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)

    def same(rows, texts):
        for row in rows:
            ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
            assert row.ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False)

    rows = bpe.decode(bpe.encode(edges, path), path).collect()
    assert len(rows) == len(EDGES) + 3
    same(rows, dict(EDGES))
    assert bpe.encode(nothing, path).count() == 0
    for row in QUERIES["op8_bpe"](spark, FOLDER).collect():
        ids = library.encode(docs[row.doc_id] or "", add_special_tokens=False).ids
        assert (row.n_tokens, row.ids_sha256) == (len(ids), brute.sha(",".join(map(str, ids))))
        assert row.decoded_sha256 == brute.sha(docs[row.doc_id] or "")


ALPHABET = "abcABC  \n\t.,'s're 12 éÉü×÷ŉ\xad\xa0　\x1c\x85中ł𝒳́̌JΣςİ<|"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_equal_the_library(name):
    import pyarrow as pa

    random = np.random.default_rng(11)
    texts = ["".join(random.choice(list(ALPHABET), random.integers(0, 60))) for _ in range(3000)]
    texts += ["x" * 3000 + " " * 2000 + "ab" * 2000, "a  <|endoftext|> b<|ENDOFTEXT|>", None]
    path = bpe.vocabulary(name)
    library = Tokenizer.from_file(path)
    encoder = bpe.merges(path).encode_texts if name.startswith("byte") else library_tokens.words(path).encode
    ids, lengths = encoder(pa.array(texts))
    at = 0
    for text, n in zip(texts, lengths):
        assert ids[at : at + n].tolist() == library.encode(text or "", add_special_tokens=False).ids
        at += n


class Counted:
    """A tokenizer that counts the words that it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.words += sum(len(text.split()) for text in texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_are_kept_over_tasks(spark, monkeypatch, words):
    """A word goes to the library once for a worker, and not again in its next task; ids stay those of the library."""
    class Table:
        sparkSession = spark
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

        def mapInArrow(self, run, schema):
            return run

    path = bpe.vocabulary("word_bpe_49k.json")
    tokens = library_tokens.WordTokens(path)
    tokens.tokenizer = Counted(tokens.tokenizer)
    monkeypatch.setattr(library_tokens, "words", lambda path: tokens)
    texts = ["the quick brown fox", "the Quick élan", "élan " + "y" * 100]
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array(texts)], ["doc_id", "text"])
    run, counts = library_tokens.tokenize(Table(), path, 2), []
    for _ in range(2):
        (out,) = run(iter([batch]))
        for text, data in zip(texts, out.column("ids").to_pylist()):
            assert np.frombuffer(data, tokens.kind).tolist() == words.encode(text, add_special_tokens=False).ids + [2]
        counts.append(tokens.tokenizer.words)
    assert counts == [6, 7]  # a word of more than 64 bytes is not kept


def test_kept_words_of_one_hash(monkeypatch, words):
    """Words with one hash, of the same and of other lengths, are told apart by their bytes."""
    monkeypatch.setattr(library_tokens, "_PRINT", np.zeros_like(library_tokens._PRINT))
    tokens = library_tokens.WordTokens(bpe.vocabulary("word_bpe_49k.json"))
    texts = ["alpha gamma", "delta beta alpha", "gamma délta Alpha"]
    for _ in range(3):
        ids, lengths = tokens.encode(pa.array(texts))
        assert ids.tolist() == [i for text in texts for i in words.encode(text, add_special_tokens=False).ids]
    assert len(tokens.prints) == 1


def test_personal_data(spark, docs, edges, nothing):
    random = np.random.default_rng(5)
    for _ in range(5000):
        text = "".join(random.choice(list("a@.1234567890+ -()é%0"), random.integers(0, 60)))
        assert pii.base_spans(text) == brute.personal(text)
    for row in QUERIES["op10_pii"](spark, FOLDER).collect():
        base = brute.personal(docs[row.doc_id] or "")
        written = ",".join(f"{pii.KINDS[k]}:{start}:{end}" for start, k, end in base)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(k == one for _, k, _ in base) for one in range(4))
        assert row.base_sha256 == brute.sha(written)
        assert set(written.split(",")) - {""} <= set(row.spans.split(","))
    field = pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    found = pii.find_entities(edges, field)
    masked = {row.doc_id: row.text for row in pii.mask(found).collect()}
    assert masked[10].count("[EMAIL]") == masked[10].count("[IP]") == masked[10].count("[CARD]") == 1
    assert "555-2186" not in masked[10]  # the second mention has no prefix and is found through its skip edge
    assert masked[1] is None and masked[8] == LONG
    assert pii.find_entities(nothing, field).count() == 0
    assert not pii.fit(np.empty((0, pii.FORM_SIZE + 3 * pii.LABELS)), np.empty(0, dtype=int)).form.any()


def test_pipeline(spark, docs, words):
    """The stages against plain versions of each on the rows that the stage before kept, and the pieces against the texts."""
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {row.doc_id for row in quality_rules.judge(table).select("doc_id", "kept").collect() if row.kept}
    left = {k: text for k, text in docs.items() if k in kept}
    groups = brute.linked(left, corpus_pipeline.NEAR_PERCENT, corpus_pipeline.NEAR_WORDS)
    left = {k: left[k] for k, (_, component) in groups.items() if k == component}
    cut = brute.cut(left)
    stages = dict(corpus_pipeline.STAGES)
    survivors = table.filter(F.col("doc_id").isin(list(left)))
    shorter = stages["repeated_passages"](spark, survivors, FOLDER)
    texts = {row.doc_id: row.text for row in shorter.collect()}
    for k, (_, _, _, data) in cut.items():
        # Where a cut falls into a character, the whole of it stays.
        assert texts[k].encode().decode() == texts[k] and whole_characters(left[k].encode(), data, texts[k].encode())
    clean = stages["personal_data"](spark, shorter, FOLDER)
    assert clean.columns == list(corpus_pipeline.COLUMNS)
    clean = {row.doc_id: row.text for row in clean.collect()}
    assert not [text for text in clean.values() if brute.personal(text or "")]
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {row.doc_id for row in rows} == set(cut)
    seen = {k: [] for k in cut}
    for row in rows:
        seen[row.doc_id].append(row)
    for k, text in clean.items():
        ids = words.encode(text or "", add_special_tokens=False).ids + [2]
        parts = sorted(seen[k], key=lambda row: row.start)
        assert [row.start for row in parts] == [0, *np.cumsum([row.length for row in parts])[:-1]]
        for row in parts:
            assert row.doc_tokens == len(ids) and row.ids_crc32 == brute.crc(ids[row.start : row.start + row.length])


def whole_characters(text, kept, found):
    """Whether found is the text without the bytes that are not kept, but for bytes of characters cut within."""
    if found == kept:
        return True
    at = 0
    for byte in found:
        at += at < len(kept) and kept[at] == byte
    return at == len(kept) and len(found) - len(kept) <= 6 * (1 + len(text) // 50)


def test_pipeline_of_odd_rows(spark):
    """Nulls, empty texts, repeated rows, a long text and an empty table go through all stages but for what the rules reject."""
    good = " ".join(f"The word number {i} of the plain text is here, and it has that." for i in range(30))
    rows = [(1, None), (2, ""), (3, good), (3, good), (None, good), (4, good + " More words come after."), (5, " \n\t"), (6, LONG)]
    rows = [(k, text, None, None, None) for k, text in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, FOLDER).columns == list(corpus_pipeline.COLUMNS), name
        assert stage(spark, df.limit(0), FOLDER).count() == 0, name
    near = corpus_pipeline.near_duplicates(spark, df, FOLDER).collect()
    assert sorted((row.doc_id is None, row.doc_id or 0) for row in near) == [(False, k) for k in (1, 2, 3, 5, 6)] + [(True, 0)]
    assert len(corpus_pipeline.personal_data(spark, df, FOLDER).collect()) == len(rows)
    packed = corpus_pipeline.packed(spark, df, FOLDER)
    assert packed.filter("start = 0").count() == len(rows) and corpus_pipeline.packed(spark, df.limit(0), FOLDER).count() == 0


def test_stages_take_small_batches(spark):
    """Long texts go to the workers in batches of bounded bytes, and masking needs one worker for a task."""
    rows = [(k, f"{k} " + "plain words of a long text " * 800, "en", "web", 0) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], ["n"])

    for name, stage in corpus_pipeline.STAGES[1:]:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, df.limit(20), FOLDER)
        assert max(row.n for row in df.mapInArrow(sizes, "n long").collect()) < 6 << 20, name
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "12345")
    masked = corpus_pipeline.personal_data(spark, df.limit(20), FOLDER)
    assert masked._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "12345"
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_pipeline_near_duplicates(spark):
    """The stage takes shingles of five words and 80 percent; some copies here link only so."""
    texts = []
    for size in (8, 20, 30, 60, 90, 150):
        base = [f"w{size}_{i}" for i in range(size)]
        for changes in (0, 1, 2, 3, 5, 8, 10, 15):
            texts.append(" ".join(base[: size - changes] + [f"c{size}_{changes}_{i}" for i in range(changes)]))
    table = dict(enumerate(texts))
    rows = [(k, text, "en", "web", len(text)) for k, text in table.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    first = {k for k, (_, component) in brute.linked(table, 80, words=5).items() if k == component}
    assert first != {k for k, (_, component) in brute.linked(table).items() if k == component}
    kept = corpus_pipeline.near_duplicates(spark, df, FOLDER)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(row.doc_id for row in kept.collect()) == sorted(first)


def test_messages_against_exact_marginals():
    """On a graph without a cycle, chain and skip edges alike, message passing gives what all labellings add up to."""
    text = "a1 b2  gamma1234 x3  gamma1234 y4  name@example.com z5"
    base = pii.base_spans(text)
    words = pii.words_of(text, base)
    assert words.chain.tolist() == [[0, 1], [2, 3], [4, 5], [6, 7]] and words.skips.tolist() == [[2, 4]]
    random = np.random.default_rng(5)
    shapes = ((pii.FORM_SIZE, pii.LABELS), (pii.LABELS, pii.LABELS), (pii.LABELS, pii.LABELS))
    field = pii.Field(*(random.normal(size=shape) for shape in shapes))
    scores = words.forms @ field.form
    exact = np.zeros((len(words.seen), pii.LABELS))
    free = [range(pii.LABELS) if seen <= 0 else [seen] for seen in words.seen.tolist()]
    for labels in itertools.product(*free):
        labels = np.array(labels)
        total = scores[np.arange(len(labels)), labels].sum()
        total += field.chain[labels[words.chain[:, 0]], labels[words.chain[:, 1]]].sum()
        total += field.skip[labels[words.skips[:, 0]], labels[words.skips[:, 1]]].sum()
        exact[np.arange(len(labels)), labels] += np.exp(total)
    assert (words.seen > 0).sum() == 1
    assert np.allclose(field.posterior(words), exact / exact.sum(axis=1, keepdims=True), atol=1e-6)


def test_mask_of_overlapping_entities(spark):
    """No character of an entity stays, also where a later one begins within it and goes on beyond it."""
    table = {
        1: "from 10.0.92.216 4912 6568 3469 8670 ok",
        2: "pay 4387513035237269@shop.example.org now",
        3: "a 4387 5130 3523 7269 b c.d@e.fg",
        4: "10.0.92.216 4912 6568 3469 8670@shop.example.org",
    }
    nobody = pii.fit(np.empty((0, pii.FORM_SIZE + 3 * pii.LABELS)), np.empty(0, dtype=int))
    df = spark.createDataFrame(list(table.items()), "doc_id long, text string")
    masked = {row.doc_id: row.text for row in pii.mask(pii.find_entities(df, nobody)).collect()}
    assert masked[1] == "from [IP][CARD] ok"
    assert masked[2] == "pay [EMAIL] now"
    assert masked[3] == "a [CARD] b [EMAIL]"
    for k, text in table.items():
        hidden = np.zeros(len(text), dtype=bool)
        for start, _, end in brute.personal(text):
            hidden[start:end] = True
        plain = "".join("\0" if gone else letter for letter, gone in zip(text, hidden))
        assert re.sub(r"(\[[A-Z]+\])+", "\0", masked[k]) == re.sub("\0+", "\0", plain)


def test_skip_edges_join_numbers_in_short_words():
    """The digits of words that follow each other count as one number; a text without a base span gets no label."""
    text = "+49 30 123 45 67 or 030 123 45 67, also 1234567"
    words = pii.words_of(text, pii.base_spans(text))
    assert {(2, 6), (3, 7), (4, 8), (6, 9), (7, 9), (8, 9)} <= set(map(tuple, words.skips.tolist()))
    field = pii.Field(np.zeros((pii.FORM_SIZE, pii.LABELS)), 9 * np.eye(pii.LABELS), 9 * np.eye(pii.LABELS))
    assert (text.index("030"), 3, text.index(", also")) in pii.added_spans(text, pii.base_spans(text), field)
    assert pii.base_spans("call 030 123 45 67") == pii.added_spans("call 030 123 45 67", [], field) == []


def test_field_is_fitted_on_late_words(spark):
    """Addresses that all stand after the first words of a long text shape the potentials too."""
    text = " ".join([*(f"no{i}" for i in range(300)), *(f"name{i}@example.org" for i in range(300))])
    field = pii.train(spark.createDataFrame([(text,)], "text string"))
    words = pii.words_of("name5@example.com", [])
    assert field.posterior(words).argmax(axis=1).tolist() == [1]
    assert pii.even_steps(3, 200).tolist() == [0, 1, 2]
    steps = pii.even_steps(1000, 200)
    assert len(set(steps.tolist())) == 200 and steps[0] == 0 and steps[-1] == 999


def test_preferences_with_a_common_prefix(spark):
    """The longest common prefix of turns is rendered once; only what an assistant says is trained."""
    ask, one, two, more = ("user", "Hi"), ("assistant", "Hello"), ("assistant", "No"), ("user", "Why")
    rows = [(1, [ask, one], [ask, two]), (2, [ask, one, more, one], [ask, one, more, two]), (3, [ask], [ask, one]), (4, [one], [two]), (5, [ask], [ask])]
    turns = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame(rows, f"id long, chosen {turns}, rejected {turns}")
    found = {row.id: row for row in preferences.format_pairs(df).collect()}
    write = lambda some: "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in some)
    for k, chosen, rejected in rows:
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1
        assert (found[k].n_common, found[k].prompt) == (n, write(chosen[:n]))
        for side, said in ((found[k].chosen_completion, chosen[n:]), (found[k].rejected_completion, rejected[n:])):
            assert side.text == write(said)
            runs = [run for role, text in said for run in ((len(f"<|{role}|>\n"), False), (len(text) + len("<|end|>\n"), role == "assistant"))]
            assert [tuple(run) for run in side.mask] == runs
