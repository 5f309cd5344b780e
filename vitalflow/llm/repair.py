r"""Conversation structure repair: the cheapest edits that make a conversation ``(s?(ua)+)?``.

A conversation's rows become symbols (role initial, fault). Equal consecutive symbols collapse into
runs. Going over a row is a min-plus matrix over four states (nothing yet, after system, after user,
after assistant; insertions before the row are part of it); a run is the matrix to the power of its
length, taken by its binary digits from cached squares. Matrices multiply associatively, so a long
conversation is cut into chunks of runs: chunks get their matrices in parallel, the costs to the end
pass backwards over the chunk matrices alone, the chunks unroll their choices in parallel for every
state they may begin in, and the states pass forwards. Within a run, choices unroll by halving it.
Among the cheapest edits the ASCII-least audit is taken: the states are deterministic in the audit's
letters, so the least letter that keeps the cost is right at every step.

Letters: K keep (0), R rerole to user or assistant (2), D delete (3; required for blank and duplicate
rows), I insert an empty user or assistant turn (2); a truncated row that stays costs 1.

Defined cases: null roles and texts are one space; a null conv_id is a conversation of its own, null
turns come first; rows of equal turn are ordered by role, then by a hash of the text, and equal rows
are neighbours, all but the first of them duplicates; a role without characters has no initial and can
not be kept; a conversation without rows costs nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, staged

# Costs, and the white space that does not count as a character.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = (".", "!", "?")

S, U, A, OTHER = range(4)                    # role initials
START, SYSTEM, USER, ASSISTANT = range(4)    # states: what the repaired turns end with
GONE = 8                                     # symbol of a row that must be deleted; the others: initial + 4 * truncated
KEEPS = {(START, S): SYSTEM, (START, U): USER, (SYSTEM, U): USER, (ASSISTANT, U): USER, (USER, A): ASSISTANT}
FILLS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}   # where rerole and insert lead
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = np.zeros((4, 4), bool)
LEGAL[S, U] = LEGAL[U, A] = LEGAL[A, U] = True
FAR = 1 << 60                                # no way
AT_END = np.array([0, 2 * INSERT, INSERT, 0])  # cost from each state to the end without further rows
CHUNK = 4096                                 # runs of a chunk
BLOCK = 6                                    # unrolled letters are remembered for runs of 2**BLOCK rows


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of two matrices, or of a matrix and a vector."""
    out = (a[:, :, None] + b[None, :, :]).min(1) if b.ndim == 2 else (a + b[None, :]).min(1)
    return np.minimum(out, FAR)


def _moves(sym: int) -> dict[str, list[tuple[int, int, int]]]:
    """letter -> (from, to, cost) of the edits of one row with this symbol."""
    out = {"D": [(s, s, DELETE) for s in range(4)]}
    if sym != GONE:
        more = TRUNCATED if sym >= 4 else 0
        out["K"] = [(s, t, more) for (s, initial), t in KEEPS.items() if initial == sym % 4]
        out["R"] = [(s, t, REROLE + more) for s, t in FILLS.items()]
    return out


@lru_cache(maxsize=None)  # nine symbols, at most 63 squares each
def power(sym: int, bit: int) -> np.ndarray:
    """The matrix of 2**bit rows of one symbol."""
    if bit:
        half = power(sym, bit - 1)
        return times(half, half)
    free = np.full((4, 4), FAR)
    np.fill_diagonal(free, 0)
    for s, t in FILLS.items():
        free[s, t] = INSERT
    free = times(free, free)    # at most two insertions in a row are ever needed
    row = np.full((4, 4), FAR)
    for moves in _moves(sym).values():
        for s, t, cost in moves:
            row[s, t] = min(row[s, t], cost)
    return times(free, row)


def bits(n: int) -> Iterator[int]:
    while n:
        yield (n & -n).bit_length() - 1
        n &= n - 1


def run_matrix(syms: list[int], lens: list[int]) -> np.ndarray:
    out = np.full((4, 4), FAR)
    np.fill_diagonal(out, 0)
    for sym, n in zip(syms, lens):
        for b in bits(n):
            out = times(out, power(sym, b))
    return out


@lru_cache(maxsize=64)
def _edits(sym: int) -> dict[tuple[int, str], tuple[int, int]]:
    return {(s, letter): (t, cost) for letter, moves in _moves(sym).items() for s, t, cost in moves}


def _row(sym: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The least letters for one row from ``state``, given the costs after it, and the state they lead to."""
    edits, out = _edits(sym), ""
    best = int(times(power(sym, 0), np.array(after))[state])
    while True:
        for letter in "DIKR":
            if letter == "I":
                to, cost = FILLS[state], INSERT
                rest = int(times(power(sym, 0), np.array(after))[to])
            elif (state, letter) in edits:
                to, cost = edits[state, letter]
                rest = after[to]
            else:
                continue
            if cost + rest == best:
                out, state, best = out + letter, to, best - cost
                break
        if letter != "I":
            return out, state


@lru_cache(maxsize=4096)
def _short(sym: int, bit: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    return _halves(sym, bit, state, after)


def _halves(sym: int, bit: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    if not bit:
        return _row(sym, state, after)
    middle = times(power(sym, bit - 1), np.array(after))
    first, state = _unroll(sym, bit - 1, state, middle)
    second, state = _unroll(sym, bit - 1, state, np.array(after))
    return first + second, state


def _unroll(sym: int, bit: int, state: int, after: np.ndarray) -> tuple[str, int]:
    """Letters and last state of 2**bit rows. Only differences of the costs matter, so these are the key."""
    key = tuple(int(x) for x in np.minimum(after - after.min(), FAR))
    return (_short if bit <= BLOCK else _halves)(sym, bit, state, key)


def unroll(syms: list[int], lens: list[int], state: int, end: np.ndarray) -> tuple[str, int]:
    """The letters of a chunk from ``state``, where ``end`` are the costs after it, and the state at its end."""
    blocks = [(sym, b) for sym, n in zip(syms, lens) for b in bits(n)]
    after = [end]
    for sym, b in reversed(blocks):
        after.append(times(power(sym, b), after[-1]))
    out = []
    for i, (sym, b) in enumerate(blocks):
        letters, state = _unroll(sym, b, state, after[len(blocks) - 1 - i])
        out.append(letters)
    return "".join(out), state


def closing(state: int) -> str:
    """The insertions after the last row."""
    return "I" * (int(AT_END[state]) // INSERT)


# ---- rows ---------------------------------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n (how often the row stands there): the test damage of the query."""
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), code.alias("code")).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.when(F.col("code") == 3, 2).otherwise(1).alias("n"))


def _hashes() -> list[Column]:
    return [F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2")]


def symbols(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, h1, h2, n, initial, fault, sym: rows without their texts, equal rows as one.

    ``fault`` is the first copy's: blank, duplicate, truncated or empty. An earlier equal row is found by
    a grouped minimum over those (conversation, role, text) that stand at several turns.
    """
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    light = rows.select("conv_id", "turn", "role", *_hashes(), "n", (bare == "").alias("blank"),
                        F.right(bare, F.lit(1)).isin(*SENTENCE_ENDS).alias("whole"))
    light = staged(light.groupBy("conv_id", "turn", "role", "h1", "h2").agg(
        F.sum("n").alias("n"), F.first("blank").alias("blank"), F.first("whole").alias("whole")), "repair-rows")
    same = ["conv_id", "role", "h1", "h2"]
    when = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    firsts = staged(light.groupBy(*same).agg(F.count(F.lit(1)).alias("turns"), F.min(when).alias("first"))
                    .where("turns > 1").select(*[F.col(c).alias(f"f_{c}") for c in same], "first"), "repair-firsts")
    met = F.col("conv_id").eqNullSafe(F.col("f_conv_id"))
    for c in same[1:]:
        met = met & (F.col(c) == F.col(f"f_{c}"))
    later = F.coalesce(when > F.col("first"), F.lit(False))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    fault = F.when(F.col("blank"), "blank").when(later, "duplicate").when(~F.col("whole"), "truncated").otherwise("")
    out = light.join(firsts, met, "left").select("conv_id", "turn", "role", "h1", "h2", "n", kind.alias("initial"), fault.alias("fault"))
    return out.withColumn("sym", F.when(F.col("fault").isin("blank", "duplicate"), GONE)
                          .otherwise(F.col("initial") + F.when(F.col("fault") == "truncated", 4).otherwise(0)))


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h1"), F.col("h2")]


CHUNKS = "conv_id bigint, at bigint, syms array<int>, lens array<bigint>, matrix array<bigint>, illegal bigint, first int, last int"
_LISTS = {"syms": pa.list_(pa.int32()), "lens": pa.list_(pa.int64()), "matrix": pa.list_(pa.int64()), "after": pa.list_(pa.int64()),
          "first": pa.int32(), "last": pa.int32(), "top": pa.bool_(), "letters": pa.list_(pa.string()), "ends": pa.list_(pa.int32()),
          "audit": pa.string(), "edit": pa.string(), "role": pa.string(), "text": pa.string(), "repaired_sha256": pa.string()}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _LISTS.get(n, pa.int64())) for n, c in zip(names, columns)], names=names)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered symbol rows -> chunks of at most ``CHUNK`` runs of one conversation, with their matrices."""
    names = ["conv_id", "at", "syms", "lens", "matrix", "illegal", "first", "last"]
    now = None   # conv_id, at, syms, lens, illegal, first initial, last initial

    def close() -> tuple:
        conv, at, syms, lens, illegal, first, last = now
        return conv, at, syms, lens, run_matrix(syms, lens).ravel().tolist(), illegal, first, last

    for batch in batches:
        out = []
        for conv, at, sym, n, initial in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "at", "sym", "n", "initial")]):
            if now is None or conv != now[0] or len(now[2]) >= CHUNK:
                if now is not None:
                    out.append(close())
                now = [conv, at, [], [], 0, initial, initial]
            elif not LEGAL[now[6], initial]:
                now[4] += 1
            now[4] += n - 1
            now[6] = initial
            for s, m in ((sym, 1), (GONE, n - 1)) if sym != GONE else ((GONE, n),):
                if m and now[2] and now[2][-1] == s:
                    now[3][-1] += m
                elif m:
                    now[2].append(s)
                    now[3].append(m)
        yield _batch(out, names)
    if now is not None:
        yield _batch([close()], names)


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each conversation from its last to its first: adds the costs after the chunk, and whether it is the first."""
    names = ["conv_id", "at", "syms", "lens", "illegal", "first", "last", "after", "top"]
    held, now, after = None, None, AT_END
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            fresh = held is None or row["conv_id"] != now
            if held is not None:
                out.append((*held, fresh))
            after = AT_END if fresh else after
            held = (*[row[c] for c in names[:7]], after.tolist())
            now, after = row["conv_id"], times(np.array(row["matrix"]).reshape(4, 4), after)
        yield _batch(out, names)
    if held is not None:
        yield _batch([(*held, True)], names)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters of each chunk for every state it may begin in; the first chunk of a conversation begins at the start."""
    names = ["conv_id", "at", "illegal", "first", "last", "cost", "letters", "ends"]
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            after = np.array(row["after"])
            cost = int(times(run_matrix(row["syms"], row["lens"]), after)[START])
            found = [unroll(row["syms"], row["lens"], s, after) if s == START or not row["top"] else ("", START) for s in range(4)]
            out.append((row["conv_id"], row["at"], row["illegal"], row["first"], row["last"], cost,
                        [x for x, _ in found], [t for _, t in found]))
        yield _batch(out, names)


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each conversation from its first to its last -> one row with the whole audit."""
    names = ["conv_id", "illegal", "cost", "audit"]
    now, pieces = None, []   # conv_id, illegal, cost, state, last initial

    def close() -> tuple:
        return now[0], now[1], now[2], "".join(pieces) + closing(now[3])

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now[0]:
                if now is not None:
                    out.append(close())
                now, pieces = [row["conv_id"], 0, row["cost"], START, None], []
            now[1] += row["illegal"] + int(now[4] is not None and not LEGAL[now[4], row["first"]])
            pieces.append(row["letters"][now[3]])
            now[3], now[4] = row["ends"][now[3]], row["last"]
        yield _batch(out, names)
    if now is not None:
        yield _batch([close()], names)


def audits(light: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit: one row per conversation that has rows."""
    rows = light.select("conv_id", "turn", "role", "h1", "h2", "sym", "n", "initial")
    rows = rows.repartitionByRange(*_order()).sortWithinPartitions(*_order()).withColumn("at", F.monotonically_increasing_id())
    conv = F.col("conv_id").asc_nulls_first()
    chunks = rows.select("conv_id", "at", "sym", "n", "initial").mapInArrow(_chunks, CHUNKS)
    back = chunks.repartition("conv_id").sortWithinPartitions(conv, F.col("at").desc()).mapInArrow(
        _backwards, "conv_id bigint, at bigint, syms array<int>, lens array<bigint>, illegal bigint, first int, last int, "
                    "after array<bigint>, top boolean")
    back = staged(back, "repair-chunks")
    letters = back.repartition("conv_id", "at").mapInArrow(
        _letters, "conv_id bigint, at bigint, illegal bigint, first int, last int, cost bigint, letters array<string>, ends array<int>")
    return letters.repartition("conv_id").sortWithinPartitions(conv, "at").mapInArrow(
        _forwards, "conv_id bigint, illegal bigint, cost bigint, audit string")


_INITIAL = {"s": S, "u": U, "a": A}
_DELETED = re.compile("D*")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit, then its ordered rows -> the repaired turns in order."""
    names = ["conv_id", "edit", "role", "text"]
    conv, audit, i, state, begun = None, "", 0, START, False

    def insertions(out: list) -> None:
        nonlocal i, state
        while i < len(audit) and audit[i] == "I":
            state = FILLS[state]
            out.append((conv, "I", ROLE[state], ""))
            i += 1

    for batch in batches:
        out = []
        for c, letters, role, text, n in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "audit", "role", "text", "n")]):
            if letters is not None:
                if begun:
                    insertions(out)
                conv, audit, i, state, begun = c, letters, 0, START, True
                continue
            while n:
                insertions(out)
                gone = min(n, _DELETED.match(audit, i).end() - i)
                i, n = i + gone, n - gone
                if n and not gone and audit[i] != "I":
                    edit = audit[i]
                    state = KEEPS[state, _INITIAL[role[0]]] if edit == "K" else FILLS[state]
                    out.append((conv, edit, role if edit == "K" else ROLE[state], text))
                    i, n = i + 1, n - 1
        yield _batch(out, names)
    if begun:
        out = []
        insertions(out)
        yield _batch(out, names)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, edit, role, text: the repaired turns; those of a conversation lie in one partition, in order.

    ``found`` are the ``audits`` of ``rows``. An audit comes ahead of its conversation's rows, so rows
    stream through and nothing but the audit of one conversation is held.
    """
    texts = rows.select("conv_id", "turn", "role", "text", F.col("n").cast("bigint").alias("n"), *_hashes(), F.lit(None).cast("string").alias("audit"))
    heads = found.select("conv_id", F.lit(None).cast("bigint").alias("turn"), *[F.lit(None).cast("string").alias(c) for c in ("role", "text")],
                         *[F.lit(None).cast("bigint").alias(c) for c in ("n", "h1", "h2")], "audit")
    conv, turn, *rest = _order()
    both = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(conv, F.col("audit").isNull(), turn, *rest)
    return both.select("conv_id", "audit", "role", "text", "n").mapInArrow(
        _apply, "conv_id bigint, edit string, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "repaired_sha256"]
    conv, sha = None, None
    for batch in batches:
        out = []
        for c, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "role", "text")]):
            if sha is None or c != conv:
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                conv, sha, lead = c, hashlib.sha256(), ""
            sha.update(f"{lead}{role}:{text}".encode())
            lead = "\n"
        yield _batch(out, names)
    if sha is not None:
        yield _batch([(conv, sha.hexdigest())], names)


def query(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: faults after the damage, cost, audit and digest of the repair."""
    ids = pick(conversations, conv_id="conv_id").select(F.col("conv_id").cast("bigint")).distinct()
    rows = damage(conversations).withColumns({c: F.col(c).cast("bigint") for c in ("conv_id", "turn")})
    light = staged(symbols(rows), "repair-symbols")
    found = staged(audits(light), "repair-audits")
    digests = repaired(rows, found).mapInArrow(_digests, "conv_id bigint, repaired_sha256 string")
    count = lambda fault, more=0: F.sum(F.when(F.col("fault") == fault, 1).otherwise(0) + more)
    copies = F.when(F.col("fault").isin("blank", "duplicate"), 0).otherwise(F.col("n") - 1)   # further copies are duplicates
    turn = F.col("turn").cast("decimal(20,0)")
    faults = light.groupBy("conv_id").agg(
        F.coalesce((F.max(turn) - F.min(turn) + 1 - F.count_distinct("turn")).try_cast("bigint"), F.lit(0)).alias("gaps"),
        F.sum(F.when(F.col("fault") == "blank", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "duplicate", F.col("n")).otherwise(copies)).alias("duplicate"),
        count("truncated").alias("truncated"))
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    parts = (ids.unionByName(faults, allowMissingColumns=True).unionByName(found, allowMissingColumns=True)
             .unionByName(digests, allowMissingColumns=True))
    of = parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in (*longs, "audit", "repaired_sha256")])
    return of.select("conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in longs],
                     F.coalesce("audit", F.lit("")).alias("audit"),
                     F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
