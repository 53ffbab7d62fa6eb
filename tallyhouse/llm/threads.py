"""Reply threads from quotations: messages linked to what they quote, then without quotes.

A message's lines are told apart by their quote marks: the level of a line is the number of
`>` before its text. Lines of one level make passages, parted at empty lines; a line like
"Ann wrote:" before a deeper quote belongs to neither. Passages are normalised (white space
collapsed, lower case), so re-wrapped and nested quotes stay the same, and hashed. A quoted
passage joins the first message of its conversation whose own text has that passage, if
that comes before. The parent of a message is the latest message found at its shallowest
level that links at all. Pointer doubling gives every message the root of its thread and
its depth, and a distributed numbering its place in the conversation: threads in the order
of their roots, replies after what they reply to, then by time.

Only whole passages link: a passage is hashed in one piece. A quotation trimmed to a part of
a paragraph, or a quoted paragraph that a reply's own lines part in two, has other hashes
than the original and links to nothing; a message with no other quotation is then the root
of a thread of its own. It counts as quoted and not as linked.

Originals are reduced to one row per passage before the join, so a passage in very many
messages is joined once for each quotation, never message by message.

Defined results: a null or empty text has no passages; a message without a linked quote is
the root of its thread; a message without conversation or place in it links to nothing; a
quotation of a later message does not link; repeated rows are messages each on their own,
the first of them by storage is the original; an empty table gives an empty one; other
columns are not read; texts are read whole and nesting may be of any depth.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, numbered, stored, with_row_key

MARKS = re.compile(r"(?:[ \t]?>)+")
ATTRIBUTION = re.compile(
    r"\s*\S.{0,200}?\b(?:wrote|writes|schrieb|a écrit|escribió)\s?:\s*$", re.IGNORECASE
)
PASSAGES = "array<struct<level:int,hash:binary>>"


def levels(text: str | None) -> list[tuple[int, str]]:
    """(level, line without its quote marks) of every line."""
    out = []
    for line in (text or "").split("\n"):
        found = MARKS.match(line)
        if found:
            out.append((found[0].count(">"), line[found.end() :].removeprefix(" ")))
        else:
            out.append((0, line))
    return out


def normalised(passage: str) -> str:
    return " ".join(passage.split()).lower()


def parse(text: str | None) -> tuple[str, list[tuple[int, bytes]]]:
    """The text without quotes, and the passages as (level, hash), its own at level 0."""
    own: list[str] = []
    passages: list[tuple[int, bytes]] = []
    held: list[str] = []
    at = 0

    def close() -> None:
        if held and (words := normalised(" ".join(held))):
            passages.append((at, xxhash.xxh3_128_digest(words.encode())))
        held.clear()

    lines = levels(text)
    for k, (level, line) in enumerate(lines):
        deeper = k + 1 < len(lines) and lines[k + 1][0] > level
        if deeper and ATTRIBUTION.match(line):
            close()
            continue
        if level != at or not line.strip():
            close()
            at = level
        if line.strip():
            held.append(line)
        if not level:
            own.append(line)
    close()
    return "\n".join(own).strip(), passages


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.binary())]))
    for batch in batches:
        parsed = [parse(t.as_py()) for t in batch.column("text")]
        passages = [[{"level": a, "hash": h} for a, h in p] for _, p in parsed]
        rest = [batch.column(c) for c in ("conv", "place", "role", FILE, ROW)]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array([own for own, _ in parsed], pa.string()), pa.array(passages, kind)],
            names=["conv", "place", "role", FILE, ROW, "own", "passages"],
        )


def _linked(messages: DataFrame) -> DataFrame:
    """Per message that quotes: parent's place and row key, passages quoted and linked."""
    said = messages.select("conv", "place", FILE, ROW, F.explode("passages").alias("p")).select(
        "conv", "place", FILE, ROW, F.col("p.level").alias("level"), F.col("p.hash").alias("hash")
    )
    first = (
        said.where((F.col("level") == 0) & F.col("place").isNotNull())
        .groupBy("conv", "hash")
        .agg(F.min(F.struct("place", FILE, ROW)).alias("original"))
    )
    first = stored(first, "originals")  # as a plain shuffle, a passage quoted very often is split
    quoted = said.where(F.col("level") > 0)
    earlier = (quoted["conv"] == first["conv"]) & (quoted["hash"] == first["hash"])
    found = quoted.join(first, earlier & (F.col("original.place") < F.col("place")), "left")
    rank = F.struct(-F.col("level"), F.col("original"))
    return found.groupBy(FILE, ROW).agg(
        F.max(F.when(F.col("original").isNotNull(), rank))["original"].alias("parent"),
        F.count("*").alias("n_quoted"),
        F.count("original").alias("n_linked"),
    )


def _roots(parents: DataFrame) -> DataFrame:
    """Root and depth of every message with a parent, in rounds that double the reach.

    A message that has reached its root takes no part in later rounds, so a few long
    conversations do not make the short ones go round with them.
    """
    itself = (F.col(FILE).alias("f"), F.col(ROW).alias("r"))
    target = (F.col(f"root.{FILE}") == F.col("f")) & (F.col(f"root.{ROW}") == F.col("r"))
    first = parents.select(FILE, ROW, F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    state = stored(
        first.join(parents.select(*itself), target, "left").select(
            FILE, ROW, "root", "depth", F.col("f").isNull().alias("done")
        ),
        "threads",
    )
    finished, active = state.where("done"), state.where("NOT done")
    while not active.isEmpty():
        known = finished.unionByName(active)
        further = known.select(
            *itself,
            F.col("root").alias("up"),
            F.col("depth").alias("more"),
            F.col("done").alias("ends"),
        )
        moved = stored(
            active.drop("done")
            .join(further, target)
            .select(
                FILE,
                ROW,
                F.col("up").alias("root"),
                (F.col("depth") + F.col("more")).alias("depth"),
                F.col("ends").alias("done"),
            ),
            "threads",
        )
        finished, active = finished.unionByName(moved.where("done")), moved.where("NOT done")
    return finished.drop("done")


def link_replies(
    messages: DataFrame,
    *,
    conv_col: str = "conv_id",
    place_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per message: conversation, place, role, text without quotes, parent's place, root's
    place, depth, position in its conversation's reply order, passages quoted and linked.
    """
    named = messages.select(
        F.col(conv_col).alias("conv"),
        F.col(place_col).cast("long").alias("place"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).alias("text"),
    )
    keyed = with_row_key(named)
    kind = keyed.schema["conv"].dataType.simpleString()
    schema = (
        f"conv {kind}, place long, role string, {FILE} long, {ROW} long, own string, "
        f"passages {PASSAGES}"
    )
    parsed = stored(keyed.mapInArrow(_parse, schema), "messages")
    links = stored(_linked(parsed), "quotations")
    roots = _roots(links.where(F.col("parent").isNotNull()))
    itself = F.struct("place", FILE, ROW)
    placed = (
        parsed.drop("passages")
        .join(links, [FILE, ROW], "left")
        .join(roots, [FILE, ROW], "left")
        .withColumn("root", F.coalesce("root", itself))
        .withColumn("root_place", F.col("root.place"))
        .withColumn("root_file", F.col(f"root.{FILE}"))
        .withColumn("root_row", F.col(f"root.{ROW}"))
        .withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))
    )
    order = ["conv", "root_place", "root_file", "root_row", "depth", "place", FILE, ROW]
    ordered, _ = numbered(placed, order, "replies")
    start = ordered.groupBy(F.col("conv").alias("c")).agg(F.min("index").alias("start"))
    start = stored(start, "starts")
    return ordered.join(start, F.col("conv").eqNullSafe(F.col("c"))).select(
        F.col("conv").alias(conv_col),
        F.col("place").alias(place_col),
        F.col("role").alias(role_col),
        F.col("own").alias(text_col),
        F.col("parent.place").alias(f"parent_{place_col}"),
        F.col("root_place").alias(f"root_{place_col}"),
        "depth",
        (F.col("index") - F.col("start")).alias("position"),
        F.coalesce("n_quoted", F.lit(0).cast("long")).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
    )


def mailed(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as mail: each turn quotes what it answers.

    A turn answers the one before, every fifth the one before that; it quotes that turn's
    text and, one level deeper, the text of the turn before the quoted one.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    skips = (F.col("turn") >= 2) & ((F.col("conv_id") + F.col("turn")) % 5 == 0)
    answering = turns.withColumn("to", F.col("turn") - F.when(skips, 2).otherwise(1))
    first = turns.select(
        F.col("conv_id").alias("c1"), F.col("turn").alias("to1"), F.col("role").alias("r1"), F.col("text").alias("t1")
    )
    second = turns.select(F.col("conv_id").alias("c2"), F.col("turn").alias("to2"), F.col("text").alias("t2"))

    def quote(text: str, marks: str):
        lines = F.replace(F.col(text), F.lit("\n"), F.lit("\n" + marks))
        return F.when(F.col(text).isNotNull(), F.concat(F.lit(marks), lines))

    joined = answering.join(
        first, (F.col("conv_id") == F.col("c1")) & (F.col("to") == F.col("to1")), "left"
    ).join(second, (F.col("conv_id") == F.col("c2")) & (F.col("to") - 1 == F.col("to2")), "left")
    wrote = F.when(F.col("t1").isNotNull(), F.concat("r1", F.lit(" wrote:")))
    body = F.concat_ws("\n", wrote, quote("t2", "> > "), quote("t1", "> "), F.col("text"))
    return joined.select("conv_id", "turn", "role", body.alias("text"))


SQL = r"""
WITH RECURSIVE turns AS (
    SELECT conv_id, turn, role, text,
           lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS said,
           turn - CASE WHEN turn >= 2 AND (conv_id + turn) % 5 = 0 THEN 2 ELSE 1 END AS answered
    FROM conversations
),
firsts AS (
    SELECT conv_id, said, min(turn) AS turn FROM turns WHERE said <> '' GROUP BY conv_id, said
),
parents AS (
    SELECT t.conv_id, t.turn, t.role, t.text, p.turn AS parent,
           CASE WHEN a.said <> '' THEN 1 ELSE 0 END
           + CASE WHEN b.said <> '' THEN 1 ELSE 0 END AS n_quoted,
           CASE WHEN p.turn < t.turn THEN 1 ELSE 0 END
           + CASE WHEN g.turn < t.turn THEN 1 ELSE 0 END AS n_linked
    FROM turns t
    LEFT JOIN turns a ON a.conv_id = t.conv_id AND a.turn = t.answered
    LEFT JOIN turns b ON b.conv_id = t.conv_id AND b.turn = t.answered - 1
    LEFT JOIN firsts p ON p.conv_id = t.conv_id AND p.said = a.said
    LEFT JOIN firsts g ON g.conv_id = t.conv_id AND g.said = b.said
),
threads AS (
    SELECT conv_id, turn, turn AS root, 0 AS depth FROM parents WHERE parent IS NULL
    UNION ALL
    SELECT p.conv_id, p.turn, t.root, t.depth + 1
    FROM parents p JOIN threads t ON p.conv_id = t.conv_id AND p.parent = t.turn
)
SELECT p.conv_id, p.turn, p.role, trim(p.text, E' \n\t\r') AS text,
       p.parent AS parent_turn, t.root AS root_turn, CAST(t.depth AS BIGINT) AS depth,
       row_number() OVER (PARTITION BY p.conv_id ORDER BY t.root, t.depth, p.turn) - 1 AS position,
       CAST(p.n_quoted AS BIGINT) AS n_quoted, CAST(p.n_linked AS BIGINT) AS n_linked
FROM parents p JOIN threads t ON p.conv_id = t.conv_id AND p.turn = t.turn
"""
