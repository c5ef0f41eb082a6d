"""Conversation structure repair on the lattice of ``cardwise.llm.lattice``.

Rows (after the seeded damage, if asked for) are range-partitioned by conversation and turn and
written with their place; a conversation so lies in one part or in several neighbouring ones, and
no task gets more than a part, however long a conversation is.

1. Faults. Blank and truncated are column expressions. A row is a duplicate if its part has the
   same role and text earlier in the conversation, or an earlier part has; of each part only the
   distinct (conversation, role and text) go to that comparison.
2. A conversation within a part is solved there. Of one over several parts, each part first sends
   the costs of crossing it between all states (16 numbers); from these come the exact prices at
   its right border, and each part is solved from every state it may be entered in. Then the
   entered states follow from left to right, and the other traces are dropped.
3. Repaired lines and audits are joined in chunks of ``CHUNK`` rows; a conversation's chunks pass
   one task in order, which holds a running SHA-256 and the audit (one value of the result).

Defined results: null ids, roles and texts count as one space, and a null id is a conversation of
its own; null turns come first; rows of one turn are ordered by role, then by a digest of the text;
an empty role has no initial, so it is never kept; repeated rows are duplicates; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwise.llm.helpers import WHITESPACE, written
from cardwise.llm.lattice import BLANK, CLOSING, DUPLICATE, INSERT, NEVER, ROLE, START, STATES, TRUNCATED, crossing, row_arcs, solve
from cardwise.session import partitions

CHUNK = 1024
KINDS = 20
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
EDITS = "part int, pos long, conv string, entry int, edits string, lead string, role string, trail string, cost long, exit int"


def space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def conversation(conv_col: str) -> Column:
    """A text for each conversation, unlike for null and any id."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("null"))


def damaged(rows: DataFrame) -> DataFrame:
    """Seeded damage of rows (conv_id, turn, role, text), by ``crc32(conv_id:turn) % 20``."""
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % KINDS
    rows = rows.withColumn("kind", kind).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text).withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


def placed(rows: DataFrame, parts: int) -> DataFrame:
    """The rows in order, with part and place (``pos``), digest, initial and the faults that a row
    shows by itself; written once."""
    last = F.regexp_replace("text", WHITESPACE + "$", "")
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text")), 256))
    rows = rows.withColumn("digest", digest).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("row")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    own = F.when(last == "", BLANK).when(~F.substring(last, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    return written(
        rows.select(
            F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"), "conv", "turn", "role", "text", "digest",
            F.substring("role", 1, 1).alias("initial"), own.alias("own"),
        ),
        "turns",
    )


def faults(turns: DataFrame) -> DataFrame:
    """(part, pos, conv, turn, initial, fault), written."""
    same = ["part", "conv", "digest"]
    firsts = turns.groupBy(*same).agg(F.min("pos").alias("first"))
    before = Window.partitionBy("conv", "digest").orderBy("part")  # a row a part
    firsts = firsts.withColumn("first", F.when(F.row_number().over(before) == 1, F.col("first")))
    rows = turns.select("part", "pos", "conv", "turn", "initial", "own", "digest").join(firsts, same)
    again = F.col("first").isNull() | (F.col("pos") != F.col("first"))
    fault = F.when(F.col("own") == BLANK, BLANK).when(again, DUPLICATE).otherwise(F.col("own"))
    return written(rows.select("part", "pos", "conv", "turn", "initial", fault.alias("fault")), "faults")


def runs(pdf: pd.DataFrame) -> Iterator[tuple[str, int, int]]:
    """(conversation, from, to) of the neighbouring rows of each conversation."""
    conv = pdf["conv"].tolist()
    at = 0
    for i in range(1, len(conv) + 1):
        if i == len(conv) or conv[i] != conv[at]:
            yield conv[at], at, i
            at = i


def lattice_rows(pdf: pd.DataFrame) -> list:
    return [row_arcs(i, f) for i, f in zip(pdf["initial"], pdf["fault"], strict=True)]


def border_crossings(pdf: pd.DataFrame) -> pd.DataFrame:
    """Crossing costs of a part's first and last conversation, which may go on in other parts."""
    pdf = pdf.sort_values("pos")
    found = [*runs(pdf)]
    rows = lattice_rows(pdf)
    return pd.DataFrame([(conv, pdf["part"].iloc[0], crossing(rows[a:b])) for conv, a, b in {found[0], found[-1]}], columns=["conv", "part", "costs"])


def border_prices(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of a conversation over several parts: what leaving each part costs in each state."""
    out = []
    leave = CLOSING
    for part, costs in sorted(zip(pdf["part"], pdf["costs"], strict=True), reverse=True):
        out.append((pdf["conv"].iloc[0], part, [*leave], len(out) == 0))
        leave = tuple(min(NEVER, *(int(costs[4 * s + t]) + leave[t] for t in STATES)) for s in STATES)
    firsts = pdf["part"].min()
    return pd.DataFrame([(c, p, v, p == firsts, z) for c, p, v, z in out], columns=["conv", "part", "leave", "opens", "closes"])


def edit_rows(pdf: pd.DataFrame, borders: pd.DataFrame) -> pd.DataFrame:
    """The edits of a part's rows, from each state in which its conversations may be entered."""
    pdf = pdf.sort_values("pos")
    rows, pos = lattice_rows(pdf), pdf["pos"].tolist()
    known = {conv: (tuple(int(x) for x in leave), opens, closes) for conv, leave, opens, closes in zip(borders["conv"], borders["leave"], borders["opens"], borders["closes"], strict=True)}
    part = pdf["part"].iloc[0] if len(pdf) else 0
    out = []
    for conv, a, b in runs(pdf) if len(pdf) else ():
        leave, opens, closes = known.get(conv, (CLOSING, True, True))
        blocks = solve(rows[a:b], leave)
        for entry in (START,) if opens else STATES:
            if not blocks[0].leads[entry] or blocks[0].prices[entry] >= NEVER:
                continue
            state, at = entry, a
            for block in blocks:
                for letters, states, cost in block.trace(state):
                    state = states[-1]
                    lead = "\n".join(f"{ROLE[s]}:" for s in states[:-1])
                    role = ROLE[state] if letters[-1] == "R" else None
                    trail, shut = None, state
                    at += 1
                    if at == b and closes and CLOSING[state]:
                        inserts = CLOSING[state] // INSERT
                        letters, cost = letters + "I" * inserts, cost + CLOSING[state]
                        trail = "\n".join(("user:", "assistant:")[-inserts:])
                    out.append((part, pos[at - 1], conv, entry, letters, lead or None, role, trail, cost, shut if at == b else None))
    frame = pd.DataFrame(out, columns=["part", "pos", "conv", "entry", "edits", "lead", "role", "trail", "cost", "exit"])
    return frame.astype({"exit": "Int32"})


def entered(pdf: pd.DataFrame) -> pd.DataFrame:
    """The states in which the parts of one conversation are entered."""
    exits = {(p, e): x for p, e, x in zip(pdf["part"], pdf["entry"], pdf["exit"], strict=True)}
    state, out = START, []
    for part in sorted(set(pdf["part"])):
        out.append((pdf["conv"].iloc[0], part, state))
        state = exits[part, state]
    return pd.DataFrame(out, columns=["conv", "part", "enters"])


def edits_of(rows: DataFrame) -> DataFrame:
    """(part, pos, conv, edits, lead, role, trail, cost) of every row; ``rows`` as of ``faults``."""
    narrow = rows.select("part", "pos", "conv", "initial", "fault")
    pieces = written(narrow.groupBy("part").applyInPandas(border_crossings, "conv string, part int, costs array<long>"), "crossings")
    several = pieces.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
    borders = pieces.join(several, "conv").groupBy("conv").applyInPandas(border_prices, "conv string, part int, leave array<long>, opens boolean, closes boolean")
    borders = written(borders, "borders")  # two rows a part at most, as all that follows of them
    solved = narrow.groupBy("part").cogroup(borders.groupBy("part")).applyInPandas(edit_rows, EDITS)
    solved = written(solved, "edits")
    exits = solved.where("exit IS NOT NULL").join(F.broadcast(borders.select("conv", "part")), ["conv", "part"])
    enters = exits.select("conv", "part", "entry", "exit").groupBy("conv").applyInPandas(entered, "conv string, part int, enters int")
    kept = solved.join(F.broadcast(enters), ["conv", "part"], "left").where(F.col("entry") == F.coalesce("enters", F.lit(START)))
    return kept.select("part", "pos", "conv", "edits", "lead", "role", "trail", "cost")


def repaired_lines(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """(part, pos, conv, edits, cost, lines): the lines that each row leaves behind, or null."""
    rows = edits.join(turns.select("part", "pos", F.col("role").alias("was"), "text"), ["part", "pos"])
    stays = ~F.rtrim(F.col("edits"), F.lit("I")).endswith("D")
    own = F.when(stays, F.concat(F.coalesce("role", "was"), F.lit(":"), F.col("text")))
    lines = F.when(F.coalesce("lead", own, "trail").isNotNull(), F.concat_ws("\n", "lead", own, "trail"))
    return rows.select("part", "pos", "conv", "edits", "cost", lines.alias("lines"))


def digests(lines: DataFrame, parts: int) -> DataFrame:
    """(conv, audit, repaired_sha256) of the lines of ``repaired_lines``."""
    chunks = lines.withColumn("chunk", F.floor(F.col("pos") % (1 << 33) / CHUNK)).groupBy("conv", "part", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "edits", "lines"))).alias("rows"))
    held = F.filter("rows", lambda r: r["lines"].isNotNull())
    chunks = chunks.select(
        "conv", "part", "chunk",
        F.array_join(F.transform("rows", lambda r: r["edits"]), "").alias("audit"),
        F.when(F.size(held) > 0, F.array_join(F.transform(held, lambda r: r["lines"]), "\n")).alias("lines"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, audit, digest, begun = None, [], hashlib.sha256(), False
        for pdf in batches:
            out = []
            for conv, letters, text in zip(pdf["conv"], pdf["audit"], pdf["lines"], strict=True):
                if conv != now:
                    if now is not None:
                        out.append((now, "".join(audit), digest.hexdigest()))
                    now, audit, digest, begun = conv, [], hashlib.sha256(), False
                audit.append(letters)
                if text is not None:
                    digest.update(("\n" if begun else "").encode() + text.encode("utf-8", "surrogatepass"))
                    begun = True
            yield pd.DataFrame(out, columns=["conv", "audit", "repaired_sha256"])
        if now is not None:
            yield pd.DataFrame([(now, "".join(audit), digest.hexdigest())], columns=["conv", "audit", "repaired_sha256"])

    dealt = chunks.repartition(parts, "conv").sortWithinPartitions("conv", "part", "chunk")
    return dealt.mapInPandas(run, "conv string, audit string, repaired_sha256 string")


def illegal_pairs(rows: DataFrame) -> DataFrame:
    """(conv, illegal): neighbouring rows whose initials are not su, ua or au."""
    within = Window.partitionBy("part", "conv").orderBy("pos")
    legal = lambda a, b: F.concat(a, b).isin("su", "ua", "au")
    inner = rows.select("conv", "part", "pos", "initial", F.lag("initial").over(within).alias("before"))
    pieces = inner.groupBy("conv", "part").agg(
        F.count_if(F.col("before").isNotNull() & ~legal(F.col("before"), F.col("initial"))).alias("illegal"),
        F.min_by("initial", "pos").alias("first"), F.max_by("initial", "pos").alias("last"),
    )
    before = F.lag("last").over(Window.partitionBy("conv").orderBy("part"))  # a row a part
    pieces = pieces.withColumn("before", before)
    border = F.col("before").isNotNull() & ~legal(F.col("before"), F.col("first"))
    return pieces.groupBy("conv").agg(F.sum(F.col("illegal") + border.cast("long")).alias("illegal"))


def conversation_repair(
    conversations: DataFrame, damage: bool = False, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    parts: int | None = None,
) -> DataFrame:
    """A row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256."""
    parts = parts or partitions(conversations.sparkSession)
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
    every = rows.select("conv_id", conversation("conv_id").alias("conv")).distinct()
    rows = (damaged(rows) if damage else rows).select(conversation("conv_id").alias("conv"), "turn", "role", "text")
    turns = placed(rows, parts)
    marked = faults(turns)
    lines = repaired_lines(turns, edits_of(marked))
    lines = written(lines, "lines")
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = marked.select("conv", "turn").distinct().groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    counts = marked.groupBy("conv").agg(*(F.count_if(F.col("fault") == n).alias(name) for name, n in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))))
    costs = lines.groupBy("conv").agg(F.sum("cost").alias("cost"))
    out = every
    for more in (gaps, counts, illegal_pairs(marked), costs, digests(lines, parts)):
        out = out.join(more, "conv", "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))


def state_sql(state: str, before: dict[str, str]) -> str:
    """The least (cost, audit) of a state after a row, from those before it (inserts included)."""
    keeps = {"s": ("z",), "u": ("z", "s", "a"), "a": ("u",)}.get(state, ())
    reroled = {"u": ("z", "s", "a"), "a": ("u",)}.get(state, ())
    step = lambda value, cost, letter: f"lpad((substr({value}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({value}, 10) || '{letter}'"
    ways = [step(before[state], 4, "D")]
    ways += [f"CASE WHEN fault IN (0, 3) AND ini = '{state}' THEN {step(before[x], 'fault', 'K')} END" for x in keeps]
    ways += [f"CASE WHEN fault IN (0, 3) THEN {step(before[x], '3 + fault', 'R')} END" for x in reroled]
    return f"least({', '.join(ways)})"


def oracle() -> str:
    plus = lambda v: f"lpad((substr({v}, 1, 9)::INT + 3)::VARCHAR, 9, '0') || substr({v}, 10) || 'I'"
    u = f"least(u, {plus('z')}, {plus('s')}, {plus('a')})"
    a = f"least(a, {plus('u0')})"
    before = {"z": "z", "s": "s", "u": "u1", "a": "a1"}
    return rf"""
WITH RECURSIVE bits AS (
  SELECT i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, s: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v FROM range(256) r(i)),
crc_table AS (SELECT list(v ORDER BY i) AS c FROM bits),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce('=' || conv_id::VARCHAR, 'null') AS conv,
         hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations),
keyed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda p: ('0x' || substr(h, 2 * p + 1, 2))::BIGINT)),
    lambda a, x: xor(c[xor(a, x) % 256 + 1], a // 256)), 4294967295) % {KINDS} AS kind FROM raw, crc_table),
hurt AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM keyed WHERE kind <> 0),
numbered AS (
  SELECT *, substr(role, 1, 1) AS ini, regexp_replace(text, '{WHITESPACE}$', '') AS body,
    row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || ':' || text), copy) AS r FROM hurt),
marked AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY r) > 1 THEN 2
    WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(ini) OVER (PARTITION BY conv ORDER BY r) || ini AS pair, count(*) OVER (PARTITION BY conv) AS n FROM numbered),
walk(conv, r, n, z, s, u, a) AS (
  SELECT conv, 0::BIGINT, max(n), '000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM marked GROUP BY conv
  UNION ALL
  SELECT conv, r, n, {state_sql("z", before)}, {state_sql("s", before)}, {state_sql("u", before)}, {state_sql("a", before)}
  FROM (SELECT *, least(u0, {plus("a1")}) AS u1 FROM (SELECT *, {a} AS a1 FROM (SELECT *, {u} AS u0 FROM (
    SELECT w.conv, m.r, w.n, z, s, u, a, ini, fault FROM walk w JOIN marked m ON m.conv = w.conv AND m.r = w.r + 1))))),
best AS (
  SELECT conv, substr(v, 1, 9)::BIGINT AS cost, substr(v, 10) AS audit FROM (
    SELECT conv, least(z, a1) AS v FROM (SELECT *, {a} AS a1 FROM (SELECT *, {u} AS u0 FROM walk WHERE r = n)))),
letters AS (SELECT conv, unnest(string_split(audit, '')) AS e, unnest(range(1, len(audit) + 1)) AS i FROM best WHERE audit <> ''),
spots AS (SELECT *, sum((e <> 'I')::INT) OVER (PARTITION BY conv ORDER BY i) AS r FROM letters),
said AS (
  SELECT x.conv, i, e, m.role, m.text, row_number() OVER (PARTITION BY x.conv ORDER BY i) AS j
  FROM spots x LEFT JOIN marked m ON m.conv = x.conv AND m.r = x.r AND e <> 'I' WHERE e <> 'D'),
roles AS (
  SELECT *, max(CASE WHEN j = 1 AND e = 'K' AND starts_with(role, 's') THEN 1 ELSE 0 END) OVER (PARTITION BY conv) AS sys FROM said),
repaired AS (
  SELECT conv, string_agg(CASE WHEN e = 'K' THEN role WHEN (j - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS t
  FROM roles GROUP BY conv),
stats AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv)
SELECT raw.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM raw) raw LEFT JOIN stats USING (conv) LEFT JOIN best USING (conv) LEFT JOIN repaired USING (conv)
"""
