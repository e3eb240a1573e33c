"""Repairing the structure of conversations by the cheapest edits, decided by one integer minimum.

A conversation is sound if the initials of its roles read (s?(ua)+)?. Edits are to keep, rerole or delete a row and to insert
an empty one. The rows of a conversation are the layers of a graph whose nodes are what the initials have come to; an edge is
up to two insertions and the edit of the next row. The weight of a path is one number: the cost in its high digits, and below
it three octal digits for each row, which name the edits in the order of their letters, with zeros at the end. Two
paths over the same rows never have one's letters begin the other's, so that the smaller number is the cheaper path and, among
equals, the one whose letters come first.

Rows come sorted, and a conversation is followed through a whole stream of batches: four numbers, and for each the hash
of the repaired text so far. After BLOCK rows the digits of a path go to a list, and its rank among the four takes their place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK_SET = r"\x20\x09-\x0D"
ENDS = ".!?"
BLOCK = 256
ROW_BITS, RANK_BITS = 9, 2
#: The letters in the order of their digits, from 1 on.
LETTERS = "DIKR"
#: What an edit costs, and what a row that stays without an end adds.
KEEP, REROLE, DELETE, INSERT, UNENDED = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The role that may follow, by what came before, and what has then come.
FOLLOWS = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
SOUND = ("su", "ua", "au")


def _insertions(node: int, most: int = 2) -> list[tuple[int, int, str, tuple[str, ...]]]:
    """What up to two insertions lead to: node, cost, letters, roles."""
    found = [(node, 0, "", ())]
    for _ in range(most):
        node, cost, letters, roles = found[-1]
        role, after = FOLLOWS[node]
        found.append((after, cost + INSERT, letters + "I", (*roles, role)))
    return found


def _digits(letters: str) -> int:
    number = 0
    for place in range(3):
        number = number << 3 | (LETTERS.index(letters[place]) + 1 if place < len(letters) else 0)
    return number


def _edges(initial: str | None, unended: bool) -> list[tuple[int, int, int, int, tuple[str, ...], str | None]]:
    """The edges over a row with this initial (None: it has to go): from, to, cost, digits, roles to insert, and the role that the
    row gets ('' for its own, None if it goes)."""
    found = []
    for start in range(4):
        for node, cost, letters, roles in _insertions(start):
            found.append((start, node, cost + DELETE, _digits(letters + "D"), roles, None))
            if initial is None:
                continue
            role, after = FOLLOWS[node]
            found.append((start, after, cost + REROLE + unended, _digits(letters + "R"), roles, role))
            if initial == role[0]:
                found.append((start, after, cost + KEEP + unended, _digits(letters + "K"), roles, ""))
            if initial == "s" and node == NOTHING:
                found.append((start, SYSTEM, cost + KEEP + unended, _digits(letters + "K"), roles, ""))
    return found


EDGES = {(initial, unended): _edges(initial, unended) for initial in (None, "s", "u", "a", "") for unended in (False, True)}
#: After the last row: what is still to insert for a sound end.
CLOSING = [
    (start, cost, _digits(letters), roles)
    for start in range(4)
    for node, cost, letters, roles in _insertions(start)
    if node == ASSISTANT or (node == start == NOTHING)
]


class Repair:
    """One conversation, row by row."""

    def __init__(self) -> None:
        self.weights: list[int | None] = [0, None, None, None]
        self.hashes = [hashlib.sha256(), None, None, None]
        self.rows = 0  # of the present block
        self.blocks: list[list[int | None]] = []
        self.ranked: list[list[int]] = [[0, 0, 0, 0]]
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.first, self.last = 0, None, None
        self.initial: str | None = None

    def add(self, turn: int | None, role: str, text: str, blank: bool, again: bool, unended: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + role[:1] not in SOUND:
            self.illegal += 1
        self.initial = role[:1]
        goes = blank or again
        unended = unended and not goes
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += unended
        initial = None if goes else self.initial if self.initial in ("s", "u", "a") else ""
        width = RANK_BITS + ROW_BITS * (self.rows + 1)
        best: list[tuple | None] = [None] * 4
        for edge in EDGES[initial, unended]:
            before = self.weights[edge[0]]
            if before is not None:
                weight = (before << ROW_BITS) + (edge[2] << width) + edge[3]
                if best[edge[1]] is None or weight < best[edge[1]][0]:
                    best[edge[1]] = (weight, edge)
        hashes = [None] * 4
        for node, found in enumerate(best):
            if found is not None:
                start, _, _, _, roles, own = found[1]
                lines = [f"{one}:" for one in roles]
                if own is not None:
                    lines.append(f"{own or role}:{text}")
                hashes[node] = self._said(start, lines)
        self.weights, self.hashes = [found and found[0] for found in best], hashes
        self.rows += 1
        if self.rows == BLOCK:
            self._close()

    def _said(self, node: int, lines: list[str]):
        found = self.hashes[node].copy()
        if lines:
            found.update((("" if node == NOTHING else "\n") + "\n".join(lines)).encode())
        return found

    def _close(self) -> None:
        """Puts the digits of the block away; the rank of a path stands for all that was decided before."""
        width = RANK_BITS + ROW_BITS * self.rows
        low = [None if weight is None else weight & (1 << width) - 1 for weight in self.weights]
        ranks = sorted((node for node in range(4) if low[node] is not None), key=low.__getitem__)
        self.blocks.append(low)
        self.ranked.append(ranks)
        self.weights = [None if low[node] is None else (weight >> width) << RANK_BITS | ranks.index(node) for node, weight in enumerate(self.weights)]
        self.rows = 0

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of the repaired text."""
        width = RANK_BITS + ROW_BITS * (self.rows + 1)
        found = min(
            ((self.weights[start] << ROW_BITS) + (cost << width) + digits, start, roles)
            for start, cost, digits, roles in CLOSING
            if self.weights[start] is not None
        )
        weight, node, roles = found
        parts, low, bits = [], weight & (1 << width) - 1, ROW_BITS * (self.rows + 1)
        for block in range(len(self.blocks), -1, -1):
            parts.append(oct(low & (1 << bits) - 1)[2:].zfill(bits // 3))
            if block:
                begin = self.ranked[block][low >> bits]
                low, bits = self.blocks[block - 1][begin], ROW_BITS * BLOCK
        audit = "".join(reversed(parts)).translate(AUDIT)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        digest = self._said(node, [f"{one}:" for one in roles]).hexdigest()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, weight >> width, audit, digest


AUDIT = str.maketrans({"0": "", **{str(digit): letter for digit, letter in enumerate(LETTERS, 1)}})


def damaged(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of conversations with faults put in by a hash of key and turn: conv_id, turn, role, text, gone.

    Of twenty rows one goes, one loses its text, one its ends of sentences, one comes twice, and one gets the role of a user.
    Rows that go stay in the table, marked gone and without text, so that no conversation is lost. Null roles and texts, and nulls
    in the hashed words, count as one space. Other columns are dropped, so that names cannot clash; an empty table gives no rows.
    """
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col(key).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(named) % 20
    said = F.coalesce(F.col(text), space)
    said = F.when(kind <= 1, "").when(kind == 2, F.regexp_replace(said, f"[{ENDS}]", "")).otherwise(said)
    rows = df.select(
        F.col(key).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias("role"),
        said.alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def faulted(rows: DataFrame) -> DataFrame:
    """Adds blank, again (role and text came earlier in the conversation) and unended to rows of conversations, with one
    conversation in one task, sorted by turn (nulls first), then role and text. Marks on rows that are gone mean nothing."""
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    same = Window.partitionBy("conv_id", "gone", "__said").orderBy(F.col("turn").asc_nulls_first())
    marked = rows.withColumn("__said", F.unhex(said)).repartition("conv_id").withColumn("__again", F.row_number().over(same))
    return marked.select(
        *("conv_id", "turn", "role", "text", "gone"),
        (~F.col("text").rlike(f"[^{BLANK_SET}]")).alias("blank"),
        (F.col("__again") > 1).alias("again"),
        (~F.col("text").rlike(f"[{ENDS}][{BLANK_SET}]*\\z")).alias("unended"),
    ).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "again")


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of a table (conv_id, turn, role, text, gone): its faults, and the cheapest edits that repair it.

    The audit names the edits in order: D delete, I insert, K keep, R rerole; of equally cheap ones the first in ASCII.
    The edit of a row goes by its first fault: blank rows and those whose role and text came earlier in the conversation must go,
    one whose text has no end costs more to keep. Rows of one turn follow by role and text, repeated rows each count, null turns
    come first, and rows of a null conv_id are one conversation. A row whose role does not begin with s, u or a can be reroled.
    A conversation all of whose rows are gone gives zeros, an empty audit and the hash of an empty text.
    An empty table gives no rows. Texts of any length are hashed as they pass. A conversation of any number of rows goes through
    one task as a sorted stream, as its hash needs; nothing is held of it but its audit.
    """
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(_RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key, done, kind = None, None, [], pa.int64()

        def emit() -> pa.RecordBatch:
            columns = list(zip(*done))
            kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv_id, turn, role, text, gone, *faults in zip(*(column.to_pylist() for column in batch.columns)):
                if now is None or conv_id != key:
                    if now is not None:
                        done.append((key, *now.result()))
                    now, key = Repair(), conv_id
                if not gone:
                    now.add(turn, role, text, *faults)
            if done:
                yield emit()
        if now is not None:
            done.append((key, *now.result()))
            yield emit()

    return faulted(rows).mapInArrow(run, schema)


def repaired_turns(rows: DataFrame, repaired: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, place (from 1), role, text and edit (I, K or R).

    Takes the table given to repair and its result. Conversations of which nothing is left have no rows.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = rows.filter(~F.col("gone")).select("conv_id", "role", "text", F.row_number().over(order).alias("row"))
    edits = repaired.select("conv_id", F.posexplode(F.split("audit", "")).alias("at", "edit")).filter(F.col("edit") != "")
    so_far = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    edits = edits.withColumns(
        {"row": F.count(F.when(F.col("edit") != "I", 1)).over(so_far), "place": F.count(F.when(F.col("edit") != "D", 1)).over(so_far)}
    ).filter(F.col("edit") != "D")
    own = F.col("edit") != "I"
    edits = edits.withColumn("row", F.when(own, F.col("row")))
    joined = edits.alias("e").join(numbered.alias("r"), (F.col("e.conv_id").eqNullSafe(F.col("r.conv_id"))) & (F.col("e.row") == F.col("r.row")), "left")
    lead = F.max(F.when((F.col("place") == 1) & (F.col("edit") == "K") & F.col("r.role").startswith("s"), 1).otherwise(0))
    lead = lead.over(Window.partitionBy("e.conv_id"))
    due = F.when((F.col("place") - lead) % 2 == 1, "user").otherwise("assistant")
    return joined.select(
        F.col("e.conv_id").alias("conv_id"),
        "place",
        F.when(F.col("edit") == "K", F.col("r.role")).otherwise(due).alias("role"),
        F.coalesce(F.col("r.text"), F.lit("")).alias("text"),
        "edit",
    )


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damages every conversation by the stated rule and repairs it: its faults, the cost and letters of the edits, the digest."""
    return repair(damaged(spark.read.parquet(f"{folder}/conversations.parquet")))


def oracle() -> str:
    """The same by a recursive query whose states are costs and letters as text."""
    return r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS kind FROM named
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE kind <> 0
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM damaged
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS n FROM seen
), faulted AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM numbered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulted GROUP BY conv_id
), inserted(a, b, cost, letters, lines) AS (
  VALUES (0, 0, 0, '', ''), (0, 2, 2, 'I', E'user:\n'), (0, 3, 4, 'II', E'user:\nassistant:\n'),
         (1, 1, 0, '', ''), (1, 2, 2, 'I', E'user:\n'), (1, 3, 4, 'II', E'user:\nassistant:\n'),
         (2, 2, 0, '', ''), (2, 3, 2, 'I', E'assistant:\n'), (2, 2, 4, 'II', E'assistant:\nuser:\n'),
         (3, 3, 0, '', ''), (3, 2, 2, 'I', E'user:\n'), (3, 3, 4, 'II', E'user:\nassistant:\n')
), edited(a, b, initial, cost, letter, role) AS (
  VALUES (0, 0, NULL, 3, 'D', NULL), (1, 1, NULL, 3, 'D', NULL), (2, 2, NULL, 3, 'D', NULL), (3, 3, NULL, 3, 'D', NULL),
         (0, 1, 's', 0, 'K', NULL), (0, 2, 'u', 0, 'K', NULL), (1, 2, 'u', 0, 'K', NULL), (2, 3, 'a', 0, 'K', NULL), (3, 2, 'u', 0, 'K', NULL),
         (0, 2, NULL, 2, 'R', 'user'), (1, 2, NULL, 2, 'R', 'user'), (2, 3, NULL, 2, 'R', 'assistant'), (3, 2, NULL, 2, 'R', 'user')
), edges AS (
  SELECT i.a, e.b, e.initial, i.cost + e.cost AS cost, i.letters || e.letter AS letters, e.letter, i.lines, e.role
  FROM inserted i JOIN edited e ON i.b = e.a
), paths AS (
  SELECT conv_id, 0::BIGINT AS n, 0 AS node, {'cost': 0, 'letters': '', 'lines': ''} AS path FROM counted
  UNION ALL
  SELECT p.conv_id, p.n + 1, e.b, min({'cost': p.path.cost + e.cost + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END,
    'letters': p.path.letters || e.letters,
    'lines': p.path.lines || e.lines || CASE WHEN e.letter = 'D' THEN '' ELSE coalesce(e.role, f.role) || ':' || f.text || E'\n' END})
  FROM paths p JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.n + 1
  JOIN edges e ON e.a = p.node AND (e.initial IS NULL OR e.initial = left(f.role, 1))
    AND (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY p.conv_id, p.n, e.b
), ended AS (
  SELECT p.conv_id, min({'cost': p.path.cost + i.cost, 'letters': p.path.letters || i.letters, 'lines': p.path.lines || i.lines}) AS path
  FROM paths p JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.n
  JOIN inserted i ON i.a = p.node AND (i.b = 3 OR (i.a = 0 AND i.b = 0)) GROUP BY p.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.path.cost, 0)::BIGINT AS cost,
  coalesce(e.path.letters, '') AS audit, sha256(coalesce(left(e.path.lines, greatest(len(e.path.lines) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def rows_of(df: DataFrame, gone: Column | None = None) -> DataFrame:
    """Undamaged conversations (conv_id, turn, role, text) as the table that repair takes; nulls count as one space."""
    text = [F.coalesce(F.col(name), F.lit(" ")).alias(name) for name in ("role", "text")]
    return df.select("conv_id", "turn", *text, F.coalesce(F.lit(False) if gone is None else gone, F.lit(False)).alias("gone"))
