"""Token alignment, conversation repair and hashed deduplication against plain versions."""

import hashlib
import heapq
import itertools
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyworks.llm import conversation_repair as repairs
from tallyworks.llm import hashed_dedup, preferences, projection_forest, token_alignment
from tallyworks.llm.bpe import byte_letters, vocabulary
from tallyworks.llm.queries import ORACLES, QUERIES
from tests.compare import connect, spark_rows, sql_rows
from tests.llm.brute import sha

FOLDER = "/root/testdata/sf0.001"
A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_hashed_dedup"])
def test_sql(spark, name):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(connect(folder), ORACLES[name])


# Token alignment

TEXTS = [
    None,
    "",
    " ",
    "  ",
    "a",
    "a  b   c \n  d\r\n\te ",
    " leading and trailing ",
    "<|endoftext|> and <s> </s><unk> <0x0A> are plain",
    "a sign ▁ of a space",
    "Ünïcode – ß 中文 日本語   　x ​﻿ \U0001f600\U0001f600 é",
    "\x00\x01 a\x0b\x0c b\x1c \x85 c",
    "12345 67 8,900.5 don't DON'T we'll",
    "same words same words same words",
    "same words same words same words",
    " ".join(f"w{i % 977}x{i} Zürich-{i}" for i in range(4000)),
    "=" * 3000 + " " * 3000 + "x",
]


def plain_alignments(texts):
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
    found = []
    for text in texts:
        if not text:
            found.append(([], [], [], []))
            continue
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        a_bytes = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a]
        names = [second.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(n[3:5], 16)]) if second.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names)]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            found.append(([], [], [], []))
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        links, i, j = [], 0, 0
        for i, end in enumerate(a_ends):
            begin = end - len(a_bytes[i])
            while j and b_ends[j - 1] > begin:
                j -= 1
            while j < len(b) and b_ends[j] - len(b_bytes[j]) < end:
                if b_ends[j] > begin:
                    links.append((i, j))
                j += 1
        common = sorted(set(a_ends) & set(b_ends))
        sides = [([], []) for _ in common]
        for side, ids, ends in ((0, a, a_ends), (1, b, b_ends)):
            for number, end in zip(ids, ends):
                sides[bisect_left(common, end)][side].append(str(number))
        groups = ["|".join(",".join(side) for side in group) for group in sides]
        found.append((a, b, links, groups))
    return found


def plain_counts(texts):
    alignments = plain_alignments(texts)
    counts = Counter()
    for a, b, links, _ in alignments:
        counts.update({(a[i], b[j]) for i, j in links})
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(n, best.get(a, 0))
    rows = []
    for a, b, links, groups in alignments:
        held = [counts[a[i], b[j]] for i, j in links]
        highest = sum(n == best[a[i]] for n, (i, _) in zip(held, links))
        rows.append((len(a), len(b), len(groups), len(links), highest, sum(held), sha(";".join(groups)) if a else ""))
    return rows


def test_lockstep():
    a, b, cut = token_alignment.lockstep(
        np.array([1, 4, 6, 7, 9]), np.array([2, 4, 5, 6, 9]), np.array([0, 0, 3, 5]), np.array([0, 0, 4, 5])
    )
    assert list(zip(a.tolist(), b.tolist(), cut.tolist())) == [
        (0, 0, False), (1, 0, False), (1, 1, True), (2, 2, False), (2, 3, True), (3, 4, False), (4, 4, True)
    ]
    empty = np.empty(0, dtype=np.int64)
    assert [len(x) for x in token_alignment.lockstep(empty, empty, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))] == [0, 0, 0]


@pytest.mark.parametrize("stretch", [1, 1024, 1 << 30])
def test_align_equals_plain(monkeypatch, stretch):
    monkeypatch.setattr(token_alignment, "STRETCH", stretch)
    one = token_alignment.align(pa.array(TEXTS), A, B)
    for row, (a, b, links, _) in enumerate(plain_alignments(TEXTS)):
        at, to = one.bounds[row], one.bounds[row + 1]
        assert one.ids_a[one.bounds_a[row] : one.bounds_a[row + 1]].tolist() == a
        assert one.ids_b[one.bounds_b[row] : one.bounds_b[row + 1]].tolist() == b
        assert list(zip(one.a[at:to] - one.bounds_a[row], one.b[at:to] - one.bounds_b[row])) == links
    assert token_alignment.align(pa.array([], pa.string()), A, B).a.tolist() == []


def test_align_texts(spark):
    rows = [(k, text, "x", "y") for k, text in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, a_ids string, slice string")
    found = {row.doc_id: row for row in token_alignment.align_texts(df, A, B).collect()}
    for k, (a, b, links, groups) in enumerate(plain_alignments(TEXTS)):
        assert (found[k].a_ids, found[k].b_ids, list(zip(found[k].link_a, found[k].link_b))) == (a, b, links)
        assert len(found[k].cut_links) == len(groups) and found[k].slice == "y"


@pytest.mark.parametrize("common", [1 << 16, 3])
def test_counts_of_links(spark, monkeypatch, common):
    """With few common pairs most counts come by the join."""
    monkeypatch.setattr(token_alignment, "COMMON_PAIRS", common)
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", 4000)
    texts = TEXTS + TEXTS[9:13]
    rows = [(k if k != 3 else None, text, "x", "y", "z") for k, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pair string, of string, n_a string").repartition(3)
    found = token_alignment.count_links(df, A, B).collect()
    expected = [(key, *rest) for (key, *_), rest in zip(rows, plain_counts(texts))]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert token_alignment.count_links(df.limit(0), A, B).collect() == []


def test_alignment_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    found = sorted(map(tuple, QUERIES["op11_token_alignment"](spark, FOLDER).collect()))
    assert found == [(row.doc_id, *rest) for row, rest in zip(docs, plain_counts([row.text for row in docs]))]


# Conversation repair


def plain_repair(rows):
    """rows: (role, text, fault). The cheapest edits by trying all, with no more than two insertions in a row."""
    best = None

    def follow(at, node, cost, audit, lines, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if at == len(rows) and node in ("", "a"):
            best = min(best or (cost, audit, lines), (cost, audit, lines))
        due = "assistant" if node == "u" else "user"
        if inserted < 2:
            follow(at, due[0], cost + 2, audit + "I", lines + [f"{due}:"], inserted + 1)
        if at < len(rows):
            role, text, fault = rows[at]
            follow(at + 1, node, cost + 3, audit + "D", lines, 0)
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                follow(at + 1, due[0], cost + 2 + more, audit + "R", lines + [f"{due}:{text}"], 0)
                if role[:1] == due[0] or (role[:1] == "s" and node == ""):
                    follow(at + 1, role[:1], cost + more, audit + "K", lines + [f"{role}:{text}"], 0)

    follow(0, "", 0, "", [], 0)
    return best[0], best[1], sha("\n".join(best[2]))


def repaired(rows):
    one = repairs.Repair()
    for turn, (role, text, fault) in enumerate(rows):
        one.add(turn, role, text, fault == "blank", fault == "duplicate", fault == "truncated")
    return one.result()


def random_rows(rng, most):
    roles, faults = ("system", "user", "assistant", "user", "assistant", "tool", ""), ("", "", "", "", "blank", "duplicate", "truncated")
    return [(rng.choice(roles), f"t{i}\n", rng.choice(faults)) for i in range(rng.randrange(most + 1))]


@pytest.mark.parametrize("block", [1, 2, 3, 256])
def test_repair_is_cheapest(monkeypatch, block):
    monkeypatch.setattr(repairs, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(60):
        rows = random_rows(rng, 4)
        assert repaired(rows)[5:] == plain_repair(rows)


def test_long_conversation_in_blocks(monkeypatch):
    rng = random.Random(7)
    for size in (1, 5, 64):
        rows = [row for _ in range(40) for row in random_rows(rng, 60)]
        monkeypatch.setattr(repairs, "BLOCK", size)
        small = repaired(rows)
        monkeypatch.setattr(repairs, "BLOCK", 1 << 30)
        assert small == repaired(rows) and len(small[6]) >= len(rows)


def test_edges_of_conversations(spark):
    plain = [
        (1, 0, "user", "Hi.", "x"),
        (1, 1, "assistant", "Yes.", "x"),
        (2, None, None, None, "x"),
        (None, 0, "user", "No id.", "x"),
        (None, 5, "assistant", "No id either!", "x"),
        (3, 4, "user", "Twice.", "x"),
        (3, 4, "user", "Twice.", "x"),
        (3, 9, "user", "Twice.", "x"),
        (3, 10, "assistant", "cut off", "x"),
        (4, 0, "tool", "Long. " * 50_000, "x"),
        (4, 1, "", "Empty role.", "x"),
        (5, 0, "user", " \t\n", "x"),
    ]
    df = spark.createDataFrame(plain, "conv_id long, turn long, role string, text string, blank string")
    rows = repairs.rows_of(df, gone=F.col("conv_id") == 1)
    result = repairs.repair(rows)
    found = {row.conv_id: tuple(row)[1:] for row in result.collect()}
    assert found[1] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert found[2] == (0, 1, 0, 0, 0, 3, "D", sha(""))
    assert found[None] == (4, 0, 0, 0, 0, 0, "KK", sha("user:No id.\nassistant:No id either!"))
    assert found[3] == (4, 0, 2, 1, 2, 7, "KDDK", sha("user:Twice.\nassistant:cut off"))
    assert found[4] == (0, 0, 0, 0, 1, 4, "RR", sha("user:" + "Long. " * 50_000 + "\nassistant:Empty role."))
    assert found[5] == (0, 1, 0, 0, 0, 3, "D", sha(""))
    turns = {}
    for row in repairs.repaired_turns(rows, result).orderBy("conv_id", "place").collect():
        turns.setdefault(row.conv_id, []).append(f"{row.role}:{row.text}")
    assert {k: sha("\n".join(v)) for k, v in turns.items()} == {k: found[k][7] for k in (None, 3, 4)}
    assert repairs.repair(rows.limit(0)).collect() == []
    assert repairs.repair(repairs.damaged(df)).count() == 6


def test_repaired_turns_spell_the_digest(spark):
    rows = repairs.damaged(spark.read.parquet(f"{FOLDER}/conversations.parquet"))
    result = repairs.repair(rows)
    turns = {}
    for row in repairs.repaired_turns(rows, result).orderBy("conv_id", "place").collect():
        turns.setdefault(row.conv_id, []).append(f"{row.role}:{row.text}")
    for row in result.collect():
        assert sha("\n".join(turns.get(row.conv_id, []))) == row.repaired_sha256


# Deduplication by a perfect hash


def digests_of(names):
    return np.frombuffer(b"".join(hashlib.sha256(str(n).encode()).digest() for n in names), dtype="<u8").reshape(-1, 4)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 5000])
def test_perfect_hash(n):
    digests = digests_of(range(n))
    hashed = hashed_dedup.PerfectHash.build(digests)
    assert sorted(hashed.slots(digests).tolist()) == list(range(n))
    others = hashed.slots(digests_of(range(n, 2 * n)))
    assert ((others >= -1) & (others < max(n, 1))).all()


def plain_groups(rows):
    """rows: (doc_id, text). doc_id, keep_id, group_size, how many rows stay, by text."""
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    keep = {text: max((k for k in keys if k is not None), default=None) for text, keys in groups.items()}
    return groups, keep


@pytest.mark.parametrize("split", ["none", "all", "half"])
@pytest.mark.parametrize("common", [4096, 1])
def test_dedup_against_history(spark, monkeypatch, split, common):
    monkeypatch.setattr(hashed_dedup, "BUCKET_ROWS", 16)
    monkeypatch.setattr(hashed_dedup, "COMMON_GROUPS", common)
    rng = random.Random(3)
    rows = [(k, f"text {rng.randrange(60)}", "x", "y") for k in range(150)]
    rows += [(k, "hot", "x", "y") for k in range(200, 300)] + [(5, None, "x", "y"), (6, "", "x", "y"), (7, "", "x", "y")]
    rows += [(400, "same row", "x", "y")] * 3 + [(None, "no id", "x", "y"), (None, "hot", "x", "y"), (500, "z" * 500_000, "x", "y"), (501, "z" * 499_999, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, row string")
    old = {"none": F.lit(False), "all": F.lit(True), "half": F.coalesce(F.col("doc_id") % 2 == 0, F.lit(True))}[split]
    found = hashed_dedup.dedup(df.filter(old), df.filter(~old)).collect()
    groups, keep = plain_groups([row[:2] for row in rows])
    expected = [(key, keep[text], len(keys), sha(text)) for text, keys in groups.items() for key in keys]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == sorted(expected, key=str)
    stay = Counter(r.text_sha256 for r in found if r.kept)
    assert stay == {sha(text): 1 for text in groups}
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    if split == "half" and common == 1:
        assert hashed_dedup.dedup(df.limit(0), df.limit(0)).collect() == []


def test_nonmembers_are_told_by_their_bytes(spark):
    """Every arrival gets some slot; only equal digests count."""
    old = hashed_dedup.located(spark.createDataFrame([(k, f"old {k}") for k in range(300)], "doc_id long, text string"))
    new = hashed_dedup.located(spark.createDataFrame([(k, f"new {k % 50}") for k in range(1000, 1200)], "doc_id long, text string"))
    groups = hashed_dedup.matched(hashed_dedup.history(old), new, old.count())
    sizes = Counter(row.n for row in groups.collect())
    assert sizes == {1: 300, 4: 50}


def test_edges_of_the_graph():
    """Every kind of row has an edge from every node, and letters of two edges never begin one another."""
    for edges in repairs.EDGES.values():
        assert {edge[0] for edge in edges} == {0, 1, 2, 3}
        for start, edge in itertools.groupby(edges, key=lambda edge: edge[0]):
            letters = [oct(one[3])[2:].rstrip("0") for one in edge]
            assert all(not (a != b and b.startswith(a)) for a in letters for b in letters)


# Preference pairs


def test_preferences_share_their_prompt(spark):
    """Nearly all pairs have turns in common, and masks spell the lengths of the completions."""
    rows = QUERIES["op9_preferences"](spark, "/root/testdata/sf0.01").collect()
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert len(rows) == turns.select("conv_id").distinct().count()
    assert sum(row.n_common > 0 for row in rows) > 0.9 * len(rows)
    for row in rows:
        for text, mask in ((row.chosen, row.chosen_mask), (row.rejected, row.rejected_mask)):
            assert sum(int(run.split(":")[0]) for run in mask.split(",") if run) == len(text)


def test_edges_of_preferences(spark):
    plain = [
        (0, 0, "user", "a", "x"), (0, 1, "assistant", "b", "x"), (0, 2, "user", "trailing", "x"),
        (1, 0, "user", "a", "x"), (1, 1, "assistant", "c", "x"), (1, 1, "assistant", "c", "x"),
        (2, None, None, None, "x"), (40, 0, "user", "q", "x"), (40, 1, "assistant", "alone " * 30_000, "x"),
        (None, 0, "assistant", "no id", "x"),
    ]
    df = spark.createDataFrame(plain, "conv_id long, turn long, role string, text string, n_common string")
    pairs = preferences.format_pairs(preferences.answer_pairs(preferences.turns_of(df)))
    found = {row.conv_id: row for row in pairs.collect()}
    assert set(found) == {0, 1, 2, 40}
    assert (found[0].n_common, found[0].prompt) == (1, "<|user|>\na<|end|>\n")
    assert found[0].chosen_completion.text == "<|assistant|>\nb<|end|>\n" and found[0].rejected_completion.text == "<|assistant|>\nc<|end|>\n"
    # The repeated answer of 1 is part of the prompt that it shares with its rejected side.
    assert found[1].n_common == 2 and found[1].rejected_completion.text == "<|assistant|>\nb<|end|>\n"
    assert found[2].n_common == 1 and found[2].chosen_completion.text == found[2].rejected_completion.text == ""
    assert found[40].n_common == 1 and found[40].rejected_completion.text == "" and len(found[40].chosen_completion.text) > 180_000
    assert preferences.answer_pairs(preferences.turns_of(df.limit(0))).count() == 0


# Nearest neighbours


def test_nearest_of_repeated_ids(spark):
    """Of rows with one id the best counts, and the others take no places of other ids; extra columns and a single vector do no harm."""
    rng = np.random.default_rng(3)
    rows = [(0, [1.0, 0.0]), (1, [0.1, 0.0]), (1, [0.9, 0.0]), (2, [0.5, 0.0]), *((7, [0.8, 0.01 * i]) for i in range(60))]
    rows += [(k, rng.normal(0, 0.05, 2).tolist()) for k in range(10, 40)]
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], "vec_id long, embedding array<double>, score string, id string")
    found = projection_forest.nearest(df, df.filter("vec_id = 0"), 20).orderBy("rank").collect()
    best = {}
    for key, vector in rows[1:]:
        best[key] = max(vector[0], best.get(key, -9.0))
    expected = sorted(best.items(), key=lambda one: (-one[1], one[0]))[:20]
    assert [(row.vec_id, row.score) for row in found] == expected
    alone = df.filter("vec_id = 0")
    assert projection_forest.nearest(alone, alone, 20).collect() == []


def test_recall_of_the_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    vectors = {row.vec_id: np.array(row.embedding, dtype=float) for row in rows if row.embedding is not None}
    ids = np.array(sorted(vectors))
    table = np.stack([vectors[k] for k in ids])
    found = {}
    for row in QUERIES["op5_projection_forest"](spark, folder).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    hits = total = 0
    for query in ids[ids % 20 == 0]:
        scores = np.where(ids == query, -np.inf, table @ vectors[query])
        nearest = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hits, total = hits + len(nearest & found.get(int(query), set())), total + len(nearest)
    assert hits >= 0.9 * total


def plain_search(forest, query, visits):
    """The leaves that leave one queue over all trees first."""
    margins = forest.directions @ np.append(query, 0.0) - forest.bounds
    queue, found = [(0.0, tree, 0) for tree in range(forest.trees)], set()
    while queue and len(found) < visits:
        missed, tree, node = heapq.heappop(queue)
        while node < forest.leaves - 1:
            near = 2 * node + 1 + (margins[tree, node] > 0)
            heapq.heappush(queue, (max(missed, abs(margins[tree, node])), tree, 4 * node + 3 - near))
            node = near
        found.add(node - (forest.leaves - 1) + tree * forest.leaves)
    return found


@pytest.mark.parametrize("depth, visits", [(0, 2), (1, 3), (4, 1), (4, 13), (6, 100), (6, 256)])
def test_leaves_seen_leave_one_queue(depth, visits):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(600, 6))
    forest = projection_forest.Forest(points, 4, depth, (points**2).sum(axis=1).max())
    seen = forest.search(points[:60], visits)
    assert [set(np.flatnonzero(row)) for row in seen] == [plain_search(forest, query, visits) for query in points[:60]]


@pytest.mark.parametrize("k, longest, kind", [(5, 1.0, "f4"), (20, 1e4, "f8"), (3, 1e120, "f8")])
def test_ranking_of_rows_that_stream_past(k, longest, kind):
    """Only leaves that a query sees count, ids come once with their best row, ties go to the smaller id; one query sees few rows."""
    rng = np.random.default_rng(4)
    rows, asked = (rng.normal(size=(n, 7)).astype(kind) for n in (5000, 300))
    rows[100:2000:3] = rows[100]
    rows[7] *= longest / np.linalg.norm(rows[7])
    ids = rng.integers(0, 4000, len(rows))
    leaves = rng.integers(0, 40, (len(rows), 2)) + np.array([0, 40])
    seen = rng.random((len(asked), 80)) < 0.3
    seen[0] = False
    seen[0, leaves[4990, 0]] = True
    length = float(np.linalg.norm(rows, axis=1).max())
    ranking = projection_forest.Ranking(np.arange(len(asked)), asked, np.packbits(seen, axis=1, bitorder="little"), k, length)
    for at in range(0, len(rows), 1700):
        some = slice(at, at + 1700)
        ranking.meet(ids[some], rows[some], (rows[some] / length).astype(np.float32), leaves[some].astype(np.uint8))
    found = {}
    for query, vec, score in zip(*ranking.best(), strict=True):
        found.setdefault(int(query), []).append((int(vec), float(score)))
    for query in range(len(asked)):
        best = {}
        for row in np.flatnonzero(seen[query][leaves].any(axis=1) & (ids != query)):
            score = float((asked[query].astype(float) * rows[row]).sum())
            best[int(ids[row])] = max(score, best.get(int(ids[row]), -np.inf))
        assert found.get(query, []) == sorted(best.items(), key=lambda one: (-one[1], one[0]))[:k]


def test_nearest_copies_no_vector_for_each_leaf(spark):
    """With all leaves seen the rows are those of brute force, and what is shuffled stays near the size of the result."""
    rng = np.random.default_rng(6)
    table = rng.normal(size=(1500, 8)).astype(np.float32)
    table[200:260] = table[200]
    df = spark.createDataFrame([(int(key), vector.tolist()) for key, vector in enumerate(table)], "vec_id long, embedding array<float>")

    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(at).length() for at in range(files.size()) if files.apply(at).getName().startswith("shuffle"))

    before = shuffled()
    found = projection_forest.nearest(df, df, 5, leaf_rows=8, block=64, visited=1.0).collect()
    assert shuffled() - before < 10 * len(found) * 24
    exact = table.astype(np.float64)
    expected = []
    for query in range(len(table)):
        scores = (exact[query] * exact).sum(axis=1)
        scores[query] = -np.inf
        order = np.lexsort((np.arange(len(table)), -scores))[:5]
        expected += [(query, rank, int(vec), scores[vec]) for rank, vec in enumerate(order, 1)]
    assert sorted(tuple(row) for row in found) == expected


def test_packs_are_bounded():
    """A pack has at most so many rows and bytes, or one row, and no row is lost."""
    batches = [pa.record_batch([pa.array(np.arange(n)), pa.array([[float(n)] * 10] * n, pa.list_(pa.float64()))], ["id", "v"]) for n in (1, 700, 40)]
    for rows, size, most in ((100, 1 << 20, 100), (1000, 52 * 90, 90), (1000, 1, 1)):
        pack = projection_forest._packs(lambda vectors: np.zeros((len(vectors), 4), np.uint8), "f4", rows, size, 64)
        packs = [row for batch in pack(iter(batches)) for row in batch.to_pylist()]
        assert max(row["n"] for row in packs) == most and sum(row["n"] for row in packs) == 741
        assert [len(row["vectors"]) for row in packs] == [40 * row["n"] for row in packs]
        assert b"".join(row["ids"] for row in packs) == b"".join(np.arange(n).tobytes() for n in (1, 700, 40))
