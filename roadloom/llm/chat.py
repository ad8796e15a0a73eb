"""Operator 8: chat formatting. A hidden Markov model recovers the turns of a plain
transcript.

States are (role, first line of a turn or further line) for the roles system, user and
assistant. A line is seen as one of a few dozen symbols: which speaker marker it begins
with, whether the line before was blank, its length class and whether it ends with a
question mark. Start, transition and emission tables are counts over training
transcripts. Viterbi's path gives each line's role and where turns begin; turns are
then rendered in one canonical form.

A long transcript is decoded in segments. Viterbi's recursion is a product of matrices
under (max, +), so each segment gives one small matrix (best score from each entering
to each leaving state); chaining those finds the states at the seams, and each segment
is then decoded between its fixed seams. The path is the same as over the whole.

No step gathers a transcript. Lines are numbered through ranges of parts (a count for
each range, then running counts inside), and turns through the segments. What one task
sees of a whole transcript is one small row for each range or segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, keep, small

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 * role + (1 for a further line of the turn)
# Speaker markers and the role that they usually stand for.
MARKERS = (
    ("system", "system|instructions?|context"),
    ("user", "user|human|q|question|customer|me"),
    ("assistant", "assistant|ai|bot|a|answer|agent|model"),
)
SEGMENT_LINES = 2_000
SYMBOLS = 4 * 2 * 3 * 2


def marker(line: Column) -> Column:
    """0 without a marker, else 1 + the number of its role."""
    out = F.lit(0)
    for i, (_, names) in reversed(list(enumerate(MARKERS))):
        out = F.when(line.rlike(rf"(?i)^\s*[\[<*#>]{{0,3}}\s*({names})\s*[\]>*]{{0,3}}\s*[:>\-]"), i + 1).otherwise(out)
    return out


def unmarked(line: Column) -> Column:
    """The line without its speaker marker."""
    names = "|".join(n for _, n in MARKERS)
    return F.regexp_replace(line, rf"(?i)^\s*[\[<*#>]{{0,3}}\s*({names})\s*[\]>*]{{0,3}}\s*[:>\-]+\s*", "")


def lines_of(transcripts: DataFrame) -> DataFrame:
    """(conv_id, part, i, line, symbol, no, segment) for each line that isn't blank of
    (conv_id, part, text). Parts of a transcript follow each other by number, texts of
    one part by their hash, and a line ends with its part. i is a line's place in its
    text, no that in the transcript without blank lines, segment no / SEGMENT_LINES."""
    n = int(transcripts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)
    lines = F.transform("split", lambda x, i: F.struct(i.alias("i"), x.alias("line"), ((i > 0) & (F.trim(F.get("split", i - 1)) == "")).cast("int").alias("gap")))
    said = F.filter(lines, lambda x: F.trim(x.line) != "")
    parts = transcripts.select("conv_id", "part", F.xxhash64("text").alias("hash"), split.alias("split")).select("conv_id", "part", "hash", said.alias("said"))
    parts = parts.repartitionByRange(n, "conv_id", "part", "hash").withColumn("at", F.spark_partition_id())
    parts = keep(parts.withColumn("n", F.size("said")), "parts")

    ranges = parts.groupBy("conv_id", "at").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("conv_id").alias("c"), F.col("at").alias("r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranges = small(keep(ranges.where("base > 0"), "ranges"))
    inside = Window.partitionBy("conv_id", "at").orderBy("part", "hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = placed.join(ranges, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("r")), "left")
    base = F.col("within") + F.coalesce("base", F.lit(0))
    rows = placed.select("conv_id", "part", base.alias("base"), F.posexplode("said").alias("k", "s"))
    rows = rows.select("conv_id", "part", "s.i", "s.line", "s.gap", (F.col("base") + F.col("k")).alias("no"))

    size = F.length(F.trim("line"))
    length = F.when(size < 20, 0).when(size < 120, 1).otherwise(2)
    ask = F.rtrim("line").endswith("?").cast("int")
    symbol = ((marker(F.col("line")) * 2 + F.col("gap")) * 3 + length) * 2 + ask
    segment = F.floor(F.col("no") / SEGMENT_LINES)
    return rows.select("conv_id", "part", "i", "line", symbol.cast("int").alias("symbol"), "no", segment.alias("segment"))


def train(lines: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log start, transition and emission tables from lines (of lines_of) with their
    true `state`.

    A symbol's emission is the product of those of its three parts (marker with gap,
    length, question mark), so combinations that training lacks are told from each
    other. Rare states lean on all lines (two counts are dealt as those of all states
    together), and every case has a floor that is the same for all states, so a case
    that no state has shown speaks for none."""
    # The line before is in the same segment, or it is the last one of the segment before.
    order = Window.partitionBy("conv_id", "segment").orderBy("no")
    lines = lines.select("conv_id", "segment", "no", "symbol", "state")
    ends = lines.groupBy("conv_id", (F.col("segment") + 1).alias("segment")).agg(F.max_by("state", "no").alias("end"))
    ends = ends.select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), "end")
    moves = lines.withColumn("was", F.lag("state").over(order))
    starts = moves.where("was is null and segment > 0").drop("was").join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")), "left")
    moves = moves.where("was is not null or segment = 0").select("symbol", "state", "was").union(starts.select("symbol", "state", F.col("end").alias("was")))
    got = moves.groupBy("was", "state", "symbol").agg(F.count("*").alias("n")).toPandas()  # at most 7 * 6 * SYMBOLS rows
    start, move = np.full(STATES, 0.1), np.full((STATES, STATES), 0.1)
    seen = np.zeros((STATES, 8, 3, 2))
    for was, state, symbol, n in got.itertuples(index=False):
        seen[state, symbol // 6, symbol // 2 % 3, symbol % 2] += n
        if was is None or was != was:
            start[state] += n
        else:
            move[int(was), state] += n
    log = lambda x: np.log(x / x.sum(-1, keepdims=True))
    parts = []
    for axis in ((2, 3), (1, 3), (1, 2)):
        own = seen.sum(axis)
        own = own + 2 * (own.sum(0) + 0.1) / (own.sum() + 0.1 * own.shape[1])
        parts.append(np.log(0.99 * own / own.sum(1, keepdims=True) + 0.01 / own.shape[1]))
    emit = parts[0][:, :, None, None] + parts[1][:, None, :, None] + parts[2][:, None, None, :]
    return log(start), log(move), emit.reshape(STATES, SYMBOLS)


def viterbi(symbols: np.ndarray, enter: np.ndarray, leave: int | None, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Best states of a segment; `enter` has the score of each state of its first line
    before that line's emission, `leave` the state of its last line, if it is fixed."""
    score = enter + emit[:, symbols[0]]
    back = np.zeros((len(symbols), STATES), np.int64)
    for t in range(1, len(symbols)):
        step = score[:, None] + move
        back[t] = step.argmax(0)
        score = step.max(0) + emit[:, symbols[t]]
    path = np.empty(len(symbols), np.int64)
    path[-1] = score.argmax() if leave is None else leave
    for t in range(len(symbols) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def segment_matrix(symbols: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """[state of the first line, state of the last line] -> best score in between."""
    score = np.full((STATES, STATES), -np.inf)
    np.fill_diagonal(score, emit[:, symbols[0]])
    for s in symbols[1:]:
        score = (score[:, :, None] + move).max(1) + emit[:, s]
    return score


def chain(matrices: list[np.ndarray], start: np.ndarray, move: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) state of each segment on the best path through all of them."""
    score, back = start, []
    for k, m in enumerate(matrices):
        enter = score if k == 0 else (score[:, None] + move).max(0)
        came = None if k == 0 else (score[:, None] + move).argmax(0)
        total = enter[:, None] + m
        back.append((came, total.argmax(0)))
        score = total.max(0)
    out, last = [], int(score.argmax())
    for came, first in reversed(back):
        out.append((int(first[last]), last))
        last = int(came[first[last]]) if came is not None else last
    return out[::-1]


def recover_turns(transcripts: DataFrame, tables: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """(conv_id, turn, role, text, first_part, first_line) of transcripts (conv_id, part, text).

    A transcript may come in any number of parts. Blank lines separate nothing by
    themselves; a transcript without other lines has no turns. Null text is empty
    text; null ids are one transcript of their own. Repeated rows of a part are read
    once, further texts of a part are read in the order of their hashes. Other columns are not read. A turn that begins a transcript in the state of
    a further line begins there all the same.
    """
    start, move, emit = tables
    bounded_batches(transcripts.sparkSession)
    given = transcripts.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("part").cast("long").alias("part"), "text").distinct()
    lines = keep(lines_of(given), "lines")

    def matrix(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        m = segment_matrix(pdf["symbol"].to_numpy(), move, emit)
        return pd.DataFrame({"conv_id": pdf["conv_id"].iloc[:1].astype("Int64"), "segment": pdf["segment"].iloc[0], "m": [m.reshape(-1)]})

    def seams(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("segment")
        found = chain([np.reshape(m, (STATES, STATES)) for m in pdf["m"]], start, move)
        return pd.DataFrame({"conv_id": pdf["conv_id"].astype("Int64"), "segment": pdf["segment"], "first": [a for a, _ in found], "last": [b for _, b in found]})

    def decode(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """States of the lines of rows that come in order; a segment ends with its last row."""
        rest = None
        for pdf in rows:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            conv = pdf["conv_id"].to_numpy()
            same = (conv[1:] == conv[:-1]) | (pd.isna(conv[1:]) & pd.isna(conv[:-1]))
            cut = np.flatnonzero(~same | (np.diff(pdf["segment"].to_numpy()) != 0)) + 1
            last = int(cut[-1]) if len(cut) else 0
            rest = pdf.iloc[last:]
            if last:
                yield solve(pdf.iloc[:last], cut)
        if rest is not None and len(rest):
            yield solve(rest, np.array([len(rest)]))

    def solve(pdf: pd.DataFrame, ends: np.ndarray) -> pd.DataFrame:
        symbols, first, last = (pdf[c].to_numpy() for c in ("symbol", "first", "last"))
        path, a = np.empty(len(pdf), np.int64), 0
        for b in ends.tolist():
            if pd.isna(first[a]):
                path[a:b] = viterbi(symbols[a:b], start, None, move, emit)
            else:
                enter = np.full(STATES, -np.inf)
                enter[int(first[a])] = 0
                path[a:b] = viterbi(symbols[a:b], enter, int(last[a]), move, emit)
            a = b
        return pd.DataFrame({"conv_id": pdf["conv_id"].astype("Int64"), "segment": pdf["segment"], "no": pdf["no"], "part": pdf["part"], "i": pdf["i"], "line": pdf["line"], "state": path})

    # Only transcripts of more than one segment need the seams.
    long_ones = lines.where("segment > 0").select("conv_id").distinct()
    parts = lines.join(F.broadcast(long_ones) if long_ones.count() <= 100_000 else long_ones, lines["conv_id"].eqNullSafe(long_ones["conv_id"]), "left_semi")
    matrices = parts.groupBy("conv_id", "segment").applyInPandas(matrix, "conv_id long, segment long, m array<double>")
    ends = matrices.groupBy("conv_id").applyInPandas(seams, "conv_id long, segment long, first int, last int").withColumnsRenamed({"conv_id": "c", "segment": "s"})
    framed = lines.join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")), "left").drop("c", "s")
    n = int(transcripts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = framed.repartition(n, "conv_id", "segment").sortWithinPartitions("conv_id", "segment", "no")
    states = dealt.mapInPandas(decode, "conv_id long, segment long, no long, part long, i int, line string, state int")

    # A turn's number: those begun in earlier segments, and those begun so far in its own.
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), (F.floor(F.col("state") / 2) + 1).cast("int"))
    states = keep(states.withColumn("new", ((F.col("no") == 0) | (F.col("state") % 2 == 0)).cast("int")), "states")
    begun = states.groupBy("conv_id", "segment").agg(F.sum("new").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select(F.col("conv_id").alias("c"), F.col("segment").alias("s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    begun = small(keep(begun.where("base > 0"), "begun"))
    inside = Window.partitionBy("conv_id", "segment").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = states.withColumn("role", role).withColumn("turn", F.sum("new").over(inside))
    marked = marked.join(begun, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("segment") == F.col("s")), "left")
    marked = marked.withColumn("turn", F.col("turn") + F.coalesce("base", F.lit(0)) - 1)
    line = F.when(F.col("new") == 1, unmarked(F.col("line"))).otherwise(F.col("line"))
    said = marked.select("conv_id", "turn", "role", "no", "part", "i", line.alias("line"))
    turns = said.groupBy("conv_id", "turn").agg(F.min_by("role", "no").alias("role"), F.array_sort(F.collect_list(F.struct("no", "line"))).alias("lines"), F.min(F.struct("part", "i")).alias("first"))
    text = F.array_join(F.transform("lines", lambda x: x.line), "\n")
    return turns.select("conv_id", "turn", "role", text.alias("text"), F.col("first.part").alias("first_part"), F.col("first.i").alias("first_line"))


def render(turns: DataFrame) -> DataFrame:
    """Each turn in canonical form, in a column `rendered`: its role between markers,
    its text without outer white space, and an end marker."""
    return turns.withColumn("rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.trim("text"), F.lit("\n<|end|>\n")))


# How raw transcripts name the speakers; which style a conversation has follows from
# its id. An empty marker leaves the turn to be told by its lines.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "[System]: ", "user": "Human: ", "assistant": "AI: "},
    {"system": "Context: ", "user": "Q: ", "assistant": "A: "},
    {"system": "**system**: ", "user": "Customer - ", "assistant": "Agent - "},
)


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """Plain transcripts of `conversations` (conv_id, turn, role, text) as a scraper
    would find them: (conv_id, part, text), one part for each turn. Markers follow one
    of four styles; one in eight turns lacks its marker; a blank line stands before
    those and before three in four of the others."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    lost = F.pmod(F.xxhash64("conv_id", "turn", F.lit("lost")), F.lit(8)) == 0
    sign = F.lit("")
    for k, names in enumerate(STYLES):
        for role, text in names.items():
            sign = F.when((style == k) & (F.col("role") == role), text).otherwise(sign)
    sign = F.when(lost, "").otherwise(sign)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    close = ~lost & (F.pmod(F.xxhash64("conv_id", "turn", F.lit("close")), F.lit(4)) == 0)
    gap = F.when(close, "").otherwise("\n")
    return conversations.select("conv_id", F.col("turn").alias("part"), F.concat(gap, sign, text).alias("text"))
