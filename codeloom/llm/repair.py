"""Repair of conversation structure over a suffix-shared word graph of role and fault signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeloom.llm.common import slices, written

# What is not one of the ASCII blanks, and the marks that end a sentence.
SOLID = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
# Costs of the edits; an unfinished text that stays costs one more.
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1
# A signature has a character for each row: the initial of its role, in capitals if the text is unfinished, other
# roles as "x" and "X", and "-" for a row that must go.
MUST_GO = "-"
# Grammar (s?(ua)+)? after nothing, a system row, a user row, an assistant row: the next state for a role.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# The one role that each state can take from an insertion or a new role.
WANTED = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
AUDITED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string, cost long, audit string"
REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` with the damage that the crc32 of ``conv_id:turn`` chooses; nulls are one space."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    kind = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return (
        rows.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            kind.alias("kind"),
        )
        .where("kind <> 0")
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
        .drop("kind", "copy")
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """Narrow rows in place of texts; of equal turns the role and a hash of the text decide, in every step alike."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.md5(text).alias("digest"),
        (~text.rlike(SOLID)).alias("is_blank"),
        (~text.rlike(ENDED)).alias("unfinished"),
    )


def signatures(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, signature)`` for each conversation of ``rows``.

    Texts are not moved: a row goes as its role, a hash and two flags.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    placed = _ordered(rows).select("*", F.row_number().over(order).alias("nth"), F.lag("role").over(order).alias("before"))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy("nth")) > 1
    initial = F.left("role", F.lit(1))
    pair = F.concat(F.left("before", F.lit(1)), initial)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    fault = (
        F.when(F.col("is_blank"), "blank").when(again, "duplicate").when(F.col("unfinished"), "truncated").otherwise("")
    )
    marked = placed.select("conv_id", "turn", "nth", fault.alias("fault"), known.alias("known"), (~pair.isin("su", "ua", "au")).alias("illegal"))
    sign = (
        F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO)
        .when(F.col("fault") == "truncated", F.upper("known"))
        .otherwise(F.col("known"))
    )
    turns = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    counted = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    # One character for each row: a conversation's signature is far shorter than its audit may be.
    chars = F.array_sort(F.collect_list(F.struct("nth", sign.alias("sign"))))
    return marked.groupBy("conv_id").agg(
        turns.alias("gaps"), *counted, F.count_if("illegal").alias("illegal"), chars.alias("chars")
    ).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", F.array_join("chars.sign", "").alias("signature"))


class Graph:
    """Cheapest edits from every node of the word graph in every grammar state.

    A node is a suffix of signatures, and it is reached from its end: its value in a state is the cost to go, the
    letters written there and the state in which the next node is entered. The best audits of a node are ranked
    among its states, so that equal costs are decided by letters and ranks without the audits themselves.
    A node's costs relative to the state 0 and its ranks are its kind. There are few kinds; the step from a kind over a
    character is computed once.
    """

    def __init__(self):
        self.kinds: dict[tuple, int] = {}
        self.steps: dict[tuple[int, str], tuple] = {}
        # At the end, states 0 and 3 accept; the others need their insertions.
        ends = ["", "II", "I", ""]
        self.end = self._kind([INSERT * len(e) for e in ends], [sorted(set(ends)).index(e) for e in ends])
        self.end_letters = ends

    def _kind(self, costs: list[int], ranks: list[int]) -> int:
        low = tuple(c - costs[0] for c in costs)
        return self.kinds.setdefault((low, tuple(ranks)), len(self.kinds))

    def step(self, after: int, sign: str) -> tuple[int, int, tuple[tuple[str, int], ...]]:
        """From the node's kind after a row to before it: the kind, the added cost of state 0, letters and next state by state."""
        if (after, sign) not in self.steps:
            self.steps[after, sign] = self._step(list(self.kinds)[after], sign)
        return self.steps[after, sign]

    def _step(self, kind: tuple, sign: str) -> tuple[int, int, tuple[tuple[str, int], ...]]:
        costs, ranks = kind
        best = []
        for state in range(4):
            options = [(DELETE + costs[state], "D", ranks[state], state)]
            if sign != MUST_GO:
                extra = UNFINISHED if sign.isupper() else 0
                if (to := STEPS[state].get(sign.lower())) is not None:
                    options.append((KEEP + extra + costs[to], "K", ranks[to], to))
                to = STEPS[state][WANTED[state]]
                options.append((REROLE + extra + costs[to], "R", ranks[to], to))
            best.append(min(options))
        # Insertions lead to other states of the same node; two of them pay for every way that is worth its cost.
        for _ in range(3):
            moved = []
            for state, (cost, letters, rank, to) in enumerate(best):
                other = best[STEPS[state][WANTED[state]]]
                moved.append(min((cost, letters, rank, to), (INSERT + other[0], "I" + other[1], other[2], other[3])))
            best = moved
        order = sorted({(letters, rank) for _, letters, rank, _ in best})
        now = self._kind([b[0] for b in best], [order.index(b[1:3]) for b in best])
        return now, best[0][0], tuple((b[1], b[3]) for b in best)


class Path:
    """The nodes from the end to the start of the signature read last; sorted reversed signatures share them.

    Of signatures sorted from their ends, each shares its longest known suffix with the one before, so every
    node is made once and only one path is held.
    """

    def __init__(self):
        self.graph = Graph()
        self.signature = ""  # reversed
        self.nodes = [(self.graph.end, 0, ())]
        self.made = 0

    def audit(self, backwards: str) -> tuple[int, str]:
        """Cost and ASCII-least audit of the cheapest repair."""
        if not backwards:
            return 0, ""
        if backwards != self.signature:
            shared = 0
            for a, b in zip(backwards, self.signature):
                if a != b:
                    break
                shared += 1
            del self.nodes[shared + 1 :]
            for sign in backwards[shared:]:
                kind, cost, _ = self.nodes[-1]
                now, added, choices = self.graph.step(kind, sign)
                # Costs of a kind are relative to the state 0 of its node.
                self.nodes.append((now, cost + added, choices))
            self.made += len(backwards) - shared
            self.signature = backwards
            state, letters = 0, []
            for _, _, choices in reversed(self.nodes[1:]):
                some, state = choices[state]
                letters.append(some)
            self.found = self.nodes[-1][1], "".join(letters) + self.graph.end_letters[state]
        return self.found


def audits(signed: DataFrame) -> DataFrame:
    """``signed(.., signature)`` with ``cost`` and ``audit``.

    Conversations are dealt by ranges of reversed signatures and read in that order. Ranges also cut
    within a signature, by id: one that a third of all conversations have is spread over several partitions,
    and each of them makes its path once.
    """
    names = [f.strip().split(" ")[0] for f in AUDITED.split(",")]
    backwards = F.reverse("signature")
    dealt = signed.select("*", backwards.alias("backwards")).repartitionByRange("backwards", "conv_id")
    dealt = dealt.sortWithinPartitions("backwards", "conv_id").select(*names[:7], "backwards")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = Path()
        for batch in batches:
            found = [path.audit(b) for b in batch.column(7).to_pylist()]
            columns = [*batch.columns[:7], pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return dealt.mapInArrow(stream, AUDITED)


class _Writer:
    """Hashes the rows of one conversation as they come, by its audit."""

    def __init__(self, audit: str):
        self.letters = iter(audit)
        self.hash = hashlib.sha256()
        self.state = 0
        self.first = True

    def _line(self, initial: str, role: str, text: str) -> None:
        self.hash.update((("" if self.first else "\n") + role + ":" + text).encode(errors="replace"))
        self.first = False
        self.state = STEPS[self.state][initial]

    def _inserted(self) -> str | None:
        for letter in self.letters:
            if letter != "I":
                return letter
            wanted = WANTED[self.state]
            self._line(wanted, ROLES[wanted], "")
        return None

    def add(self, role: str, text: str) -> None:
        letter = self._inserted()
        if letter == "K":
            self._line(role[0], role, text)
        elif letter == "R":
            wanted = WANTED[self.state]
            self._line(wanted, ROLES[wanted], text)

    def end(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """One row per conversation of ``audited`` with the hash of its repaired ``role:text`` lines.

    A conversation's row comes before its turns in the sorted stream of its partition. Turns are hashed as they pass and
    none are gathered; only the audit, a character for each edit, is held.
    """
    ddl = [f.strip().split(" ") for f in REPAIRED.split(",")]
    names = [n for n, _ in ddl]
    heads = audited.select(
        *names[:-1], F.lit(0).alias("is_turn"), *(F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "string")))
    )
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), *(F.lit(None).cast(t).alias(n) for n, t in ddl[1:-1]),
        F.lit(1).alias("is_turn"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.md5(text).alias("digest"), text.alias("text"),
    )
    order = ["conv_id", "is_turn", F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = heads.unionByName(turns).repartition("conv_id").sortWithinPartitions(*order)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, writer, out = None, None, []

        def given() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.string()] * 2
            columns = list(zip(*out)) or [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        last = len(names) - 1
        for batch in slices(batches):
            is_turn, roles, texts = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("is_turn", "role", "text"))
            for i, turn in enumerate(is_turn):
                if turn:
                    writer.add(roles[i], texts[i])
                    continue
                if writer:
                    out.append((*head, writer.end()))
                head = [batch.column(c)[i].as_py() for c in range(last)]
                writer = _Writer(head[-1])
            yield given()
        if writer:
            out.append((*head, writer.end()))
        yield given()

    return dealt.mapInArrow(stream, REPAIRED)


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation of ``rows(conv_id, turn, role, text)``, one row each.

    Rows follow each other by turn, null turns first, equal turns by role and a hash of the text. Null roles and
    texts are one space, which is a blank text. A row's first fault counts: blank, duplicate (role and text were
    there before) or truncated (no mark ends it). Rows are kept, given another role, deleted or inserted so that the initials of the roles
    follow ``(s?(ua)+)?`` at least cost; of equally cheap audits the ASCII-least is taken. Only roles with the
    initials s, u and a can be kept; an empty role has none. Rows with a null conv_id are one conversation. Other columns are
    not read; an empty table gives an empty one. A conversation's audit and signature are one string each;
    its texts are never gathered.
    """
    return repaired(rows, audits(written(signatures(rows), "signatures")))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair(damaged(given)).withColumnRenamed("conv_id", "_id")
    # Conversations that lost all rows have no repair.
    every = given.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    joined = every.join(found.hint("merge"), every["conv_id"].eqNullSafe(found["_id"]), "left")
    return joined.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# The same edits by recursion over rows from each conversation's end; DuckDB has no crc32, hence the bitwise one.
OP13_SQL = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
    ), 4294967295) % 20 AS kind
  FROM named
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER w AS nth, left(lag(role) OVER w, 1) || left(role, 1) AS pair
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))
), faulty AS (
  SELECT *, CASE
      WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nth) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated'
      ELSE '' END AS fault,
    left(role, 1) AS initial
  FROM placed
), signed AS (
  SELECT conv_id, nth, initial, CASE fault WHEN 'truncated' THEN 1 WHEN '' THEN 0 ELSE 1000000 END AS extra FROM faulty
), go AS (
  SELECT conv_id, max(nth) + 1 AS nth, {'c': 0::BIGINT, 'a': ''} AS g0, {'c': 4::BIGINT, 'a': 'II'} AS g1,
    {'c': 2::BIGINT, 'a': 'I'} AS g2, {'c': 0::BIGINT, 'a': ''} AS g3
  FROM faulty GROUP BY conv_id
  UNION ALL
  SELECT conv_id, nth,
    list_min([b0, {'c': b2.c + 2, 'a': 'I' || b2.a}, {'c': b3.c + 4, 'a': 'II' || b3.a}]),
    list_min([b1, {'c': b2.c + 2, 'a': 'I' || b2.a}, {'c': b3.c + 4, 'a': 'II' || b3.a}]),
    list_min([b2, {'c': b3.c + 2, 'a': 'I' || b3.a}]),
    list_min([b3, {'c': b2.c + 2, 'a': 'I' || b2.a}])
  FROM (
    SELECT g.conv_id, s.nth,
      list_min([{'c': g0.c + 3, 'a': 'D' || g0.a}, {'c': g2.c + 2 + extra, 'a': 'R' || g2.a},
        {'c': CASE initial WHEN 's' THEN g1.c WHEN 'u' THEN g2.c ELSE 1000000 END + extra,
         'a': 'K' || CASE initial WHEN 's' THEN g1.a ELSE g2.a END}]) AS b0,
      list_min([{'c': g1.c + 3, 'a': 'D' || g1.a}, {'c': g2.c + 2 + extra, 'a': 'R' || g2.a},
        {'c': CASE initial WHEN 'u' THEN g2.c ELSE 1000000 END + extra, 'a': 'K' || g2.a}]) AS b1,
      list_min([{'c': g2.c + 3, 'a': 'D' || g2.a}, {'c': g3.c + 2 + extra, 'a': 'R' || g3.a},
        {'c': CASE initial WHEN 'a' THEN g3.c ELSE 1000000 END + extra, 'a': 'K' || g3.a}]) AS b2,
      list_min([{'c': g3.c + 3, 'a': 'D' || g3.a}, {'c': g2.c + 2 + extra, 'a': 'R' || g2.a},
        {'c': CASE initial WHEN 'u' THEN g2.c ELSE 1000000 END + extra, 'a': 'K' || g2.a}]) AS b3
    FROM go g JOIN signed s ON s.conv_id IS NOT DISTINCT FROM g.conv_id AND s.nth = g.nth - 1
  )
), audited AS (
  SELECT conv_id, g0.c AS cost, g0.a AS audit FROM go WHERE nth = 1
), letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS pos FROM audited
), used AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS nth, count(*) FILTER (letter <> 'D') OVER w AS place
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
), written AS (
  SELECT u.*, f.role, f.text,
    max(CASE WHEN place = 1 AND letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY u.conv_id) AS system
  FROM used u LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM u.conv_id AND f.nth = u.nth
), lines AS (
  SELECT conv_id, sha256(string_agg(
      CASE letter WHEN 'K' THEN role ELSE CASE (place - system) % 2 WHEN 1 THEN 'user' ELSE 'assistant' END END || ':'
      || CASE letter WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY pos)) AS digest
  FROM written WHERE letter <> 'D' GROUP BY conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN audited a ON a.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM e.conv_id
"""
