"""Structure repair of conversations by a run-length dynamic program (operator 13)."""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

# what separates words, as in the other operators
BLANKS = " \t\n\x0b\x0c\r"
RULE_COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
CUT_COST = 3  # of an undeleted truncated row
MUST_DELETE = "x"
INF = 1 << 60
# role initials that lead from state to state: start, after system, after user, after assistant
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPT = (0, INF, INF, 0)
ROLES = {"u": "user", "a": "assistant"}
# rows and characters of a block
ROWS = 512
CHARS = 1 << 18


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damaged rows (conv, turn, role, text, copy): nulls in texts, roles and the key are one space.

    By the CRC-32 of `conv:turn` modulo 20, 0 drops a row (text and role are null then, so the conversation stays known), 1 empties the text,
    2 removes its `[.!?]`, 3 repeats the row, 4 sets the role to user.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    words = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(blank(text), ".!?", "")).otherwise(blank(text))
    made = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.when(kind != 0, F.when(kind == 4, F.lit("user")).otherwise(blank(role))).alias("role"),
        F.when(kind != 0, words).alias("text"),
        F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return made.withColumn("copy", F.explode("copies")).drop("copies")


def _tail(text: str) -> Column:
    """The last character of a text that is not a separator, empty without one."""
    chars = "".join(f"\\u{ord(c):04x}" for c in BLANKS)
    return F.right(F.expr(f"trim(TRAILING '{chars}' FROM `{text}`)"), F.lit(1))


# ---- the dynamic program; states and symbols are few, so everything about them is cached


def row_symbol(role: str, tail: str, seen: bool) -> str:
    """The symbol of a row: its role's initial, if that is s, u or a (else o), upper case if it is truncated, or x if it must go."""
    if not tail or seen:
        return MUST_DELETE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial if tail in ".!?" else initial.upper()


@functools.cache
def edits(symbol: str | None) -> tuple[tuple[str, int, int, int, bool], ...]:
    """(letter, state, next state, cost, whether it uses the row) of all edits before or at a row; None is the end."""
    out = [("I", s, t, RULE_COSTS["I"], False) for s, to in enumerate(NEXT) for i, t in to.items() if i in ROLES]
    if symbol is None:
        return tuple(out)
    out += [("D", s, s, RULE_COSTS["D"], True) for s in range(4)]
    if symbol != MUST_DELETE:
        cut = CUT_COST if symbol.isupper() else 0
        out += [("K", s, to[symbol.lower()], RULE_COSTS["K"] + cut, True) for s, to in enumerate(NEXT) if symbol.lower() in to]
        out += [("R", s, t, RULE_COSTS["R"] + cut, True) for s, to in enumerate(NEXT) for i, t in to.items() if i in ROLES]
    return tuple(out)


def times(a, b):
    """Min-plus product of 4 x 4 matrices (tuples of rows)."""
    return tuple(tuple(min(INF, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def apply(matrix, costs):
    """Cheapest costs before a stretch from those after it."""
    return tuple(min(INF, *(m + c for m, c in zip(row, costs))) for row in matrix)


IDENTITY = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))


@functools.cache
def insertions():
    """Cheapest costs of insertions alone."""
    one = [list(r) for r in IDENTITY]
    for _, s, t, cost, _ in edits(None):
        one[s][t] = min(one[s][t], cost)
    step = tuple(map(tuple, one))
    return times(times(step, step), times(step, step))


@functools.cache
def power(symbol: str, exponent: int):
    """Min-plus transition of 2 ** exponent equal rows, with insertions before each."""
    if exponent:
        return times(power(symbol, exponent - 1), power(symbol, exponent - 1))
    one = [[INF] * 4 for _ in range(4)]
    for _, s, t, cost, uses in edits(symbol):
        if uses:
            one[s][t] = min(one[s][t], cost)
    return times(insertions(), tuple(map(tuple, one)))


def run_lengths(symbols: str):
    """(symbol, length) of runs of equal symbols."""
    start = 0
    for i in range(1, len(symbols) + 1):
        if i == len(symbols) or symbols[i] != symbols[start]:
            yield symbols[start], i - start
            start = i


def advance(symbols: str, costs):
    """Cheapest costs before the rows from those after them: every run through the binary powers of its transition."""
    for symbol, n in reversed(list(run_lengths(symbols))):
        for e in range(n.bit_length()):
            if n >> e & 1:
                costs = apply(power(symbol, e), costs)
    return costs


def transition(symbols: str):
    """The min-plus matrix of the rows."""
    columns = [advance(symbols, tuple(0 if i == j else INF for i in range(4))) for j in range(4)]
    return tuple(zip(*columns))


def end_costs():
    """Cheapest costs to the end, after the last row."""
    return apply(insertions(), ACCEPT)


@functools.lru_cache(1 << 14)
def _choices(symbol: str | None, costs):
    """Per state the letters up to the next row and the state there, least letters first among the cheapest.

    `costs` are those after the row, less their minimum.  Also the costs before the row.
    """
    before = apply(power(symbol, 0), costs) if symbol else apply(insertions(), ACCEPT)
    out = []
    for state in range(4):
        letters, s = "", state
        while before[state] < INF:
            if symbol is None and ACCEPT[s] == before[s]:
                break
            for letter, _, t, cost, uses in sorted(e for e in edits(symbol) if e[1] == s):
                if cost + (costs[t] if uses else before[t]) == before[s]:
                    break
            letters, s = letters + letter, t
            if uses:
                break
        out.append((letters, s))
    return tuple(out), before


def unroll(symbols: str, costs, state: int, last: bool):
    """(audit, state after it) of the cheapest edits of the rows, from `state` and the costs after them; `last` adds the end's."""
    steps = []
    for symbol in reversed(symbols):
        least = min(costs)
        choices, before = _choices(symbol, tuple(min(INF, c - least) if c < INF else INF for c in costs))
        costs = tuple(c + least if c < INF else INF for c in before)
        steps.append(choices)
    audit = []
    for choices in reversed(steps):
        letters, state = choices[state]
        audit.append(letters)
    if last:
        letters, state = _choices(None, ACCEPT)[0][state]
        audit.append(letters)
    return "".join(audit), state


def repaired(rows, audit: str, state: int):
    """`role:text` of the rows (role, text) after the edits, from the state before them."""
    rows = iter(rows)
    for letter in audit:
        if letter == "D":
            next(rows)
            continue
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "K":
            state = NEXT[state][role[:1]]
        else:
            initial = next(i for i in NEXT[state] if i in ROLES)
            role, state = ROLES[initial], NEXT[state][initial]
        yield f"{role}:{text}"


# ---- blocks of rows


class Block:
    """What is known of neighbouring rows of a conversation, in the order of their turns."""

    def __init__(self):
        self.turns, self.roles, self.texts, self.tails, self.chars = [], [], [], [], 0

    def add(self, turn, role, text, tail):
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.tails.append(tail)
        self.chars += len(text)

    def full(self, rows: int, chars: int) -> bool:
        return len(self.turns) >= rows or self.chars >= chars


def faults(symbols: str, tails) -> tuple[int, int, int]:
    """Numbers of blank, duplicate and truncated rows."""
    blank = sum(not t for t in tails)
    return blank, symbols.count(MUST_DELETE) - blank, sum(c.isupper() for c in symbols)


def illegal(roles) -> int:
    firsts = [r[:1] for r in roles]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))


def gaps(turns) -> int:
    known = [t for t in turns if t is not None]
    return known[-1] - known[0] + 1 - len(set(known)) if known else 0


def finish(block: Block) -> dict:
    """The result of a conversation that is one block."""
    seen, symbols = set(), []
    for role, text, tail in zip(block.roles, block.texts, block.tails):
        symbols.append(row_symbol(role, tail, (role, text) in seen))
        seen.add((role, text))
    symbols = "".join(symbols)
    audit, _ = unroll(symbols, end_costs(), 0, True)
    text = "\n".join(repaired(zip(block.roles, block.texts), audit, 0))
    blank, duplicate, truncated = faults(symbols, block.tails)
    return {"gaps": gaps(block.turns), "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal(block.roles),
            "cost": advance(symbols, end_costs())[0], "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
NAMES = [f.split()[0] for f in RESULT.split(", ")]
ARROW = [(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in NAMES]


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _sorted_blocks(rows: DataFrame, max_rows: int, max_chars: int) -> DataFrame:
    """Finished conversations (`done`) and blocks of the others, from rows range-partitioned and sorted by (conv, turn).

    A conversation that lies inside a partition and fits one block is finished at once.  One that touches a border of a partition,
    where more of it may follow, or is larger, becomes blocks (part, seq) with its rows; so a conversation of any size is spread over tasks.
    """
    # the range has a last column that tells equal rows apart, so that repeated rows can be split
    keyed = rows.withColumns({"tail": _tail("text"), "head": F.substring("text", 1, 64), "hash": F.xxhash64("text"), "rid": F.monotonically_increasing_id()})
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "head", "hash", "rid"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "tail")
    conv_type = rows.schema["conv"].dataType

    def run(batches):
        from pyspark import TaskContext

        part, seq, out = TaskContext.get().partitionId(), 0, []
        names = ["conv", "done", "part", "seq", *NAMES, "rows"]
        row = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("tail", pa.string())]))

        def table(conv_arrow):
            columns = [pa.array([o.get(n) for o in out], t) for n, t in [("conv", conv_arrow), ("done", pa.bool_()), ("part", pa.int64()), ("seq", pa.int64()), *ARROW, ("rows", row)]]
            return pa.RecordBatch.from_arrays(columns, names=names)

        def held(block):
            return [{"turn": t, "role": r, "text": x, "tail": e} for t, r, x, e in zip(block.turns, block.roles, block.texts, block.tails)]

        conv, block, cut, size, kind = None, None, True, 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for new, turn, role, text, tail in zip(*(c.to_pylist() for c in batch.columns)):
                if block is None or new != conv:
                    if block is not None:
                        out.append({"conv": conv, "part": part, "seq": seq} | ({"done": False, "rows": held(block)} if cut else {"done": True, **finish(block)}))
                        seq, cut = seq + 1, False
                    conv, block = new, Block()
                elif block.full(max_rows, max_chars):
                    out.append({"conv": conv, "part": part, "seq": seq, "done": False, "rows": held(block)})
                    seq, cut, block = seq + 1, True, Block()
                if text is not None:  # not dropped
                    block.add(turn, role, text, tail)
                    size += len(text)
                if len(out) >= 256 or size >= 4 * max_chars:
                    if out:
                        yield table(kind)
                    out, size = [], 0
        if block is not None:
            out.append({"conv": conv, "part": part, "seq": seq, "done": False, "rows": held(block)})
        if out:
            yield table(kind)

    return ranged.mapInArrow(run, f"conv {conv_type.simpleString()}, done boolean, part long, seq long, {RESULT}, rows array<struct<turn:bigint,role:string,text:string,tail:string>>")


def _summaries(blocks: DataFrame, duplicates: DataFrame) -> DataFrame:
    """(conv, part, seq, symbols, matrix, first, last, ...) of blocks: what their neighbours need to know."""
    at = blocks.join(duplicates, (F.col("part") == F.col("d_part")) & (F.col("seq") == F.col("d_seq")), "left").select("conv", "part", "seq", "rows.role", "rows.tail", "rows.turn", "again")

    def run(batches):
        for b in batches:
            out = []
            for roles, tails, turns, again in zip(*(c.to_pylist() for c in b.columns[3:])):
                seen = set(again or ())
                symbols = "".join(row_symbol(r, t, i in seen) for i, (r, t) in enumerate(zip(roles, tails)))
                known = [t for t in turns if t is not None]
                blank, duplicate, truncated = faults(symbols, tails)
                out.append((symbols, [c for row in transition(symbols) for c in row], roles[0] if roles else None, roles[-1] if roles else None, known[0] if known else None,
                            known[-1] if known else None, len(set(known)), blank, duplicate, truncated, illegal(roles)))
            strings, ints = pa.string(), pa.int64()
            types = [strings, pa.list_(ints), strings, strings, *[ints] * 7]
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(types), types)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *columns], names=["conv", "part", "seq", "symbols", "matrix", "first", "last", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal"])

    return at.mapInArrow(run, f"conv {_type(blocks, 'conv')}, part long, seq long, symbols string, matrix array<long>, first string, last string, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long")


def _in_order(df: DataFrame, descending: bool = False) -> DataFrame:
    """Rows of each conversation together, by block."""
    order = [F.desc("part"), F.desc("seq")] if descending else ["part", "seq"]
    return df.repartition("conv").sortWithinPartitions("conv", *order)


def _backward(summaries: DataFrame) -> DataFrame:
    """(part, seq, costs, last): cheapest costs after each block, from the conversation's last block to its first."""
    rows = _in_order(summaries, True).select("conv", "part", "seq", "matrix")

    def run(batches):
        conv, costs = object(), None
        for b in batches:
            out = []
            for new, part, seq, matrix in zip(*(c.to_pylist() for c in b.columns)):
                last = new != conv
                if last:
                    conv, costs = new, end_costs()
                out.append((part, seq, list(costs), last))
                costs = apply([matrix[i : i + 4] for i in range(0, 16, 4)], costs)
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, types)], names=["c_part", "c_seq", "costs", "final"])

    return rows.mapInArrow(run, "c_part long, c_seq long, costs array<long>, final boolean")


def _unrolled(summaries: DataFrame, costs: DataFrame) -> DataFrame:
    """Summaries with `audits` and `exits`: the cheapest edits of each block from every state."""
    joined = summaries.join(costs, (F.col("part") == F.col("c_part")) & (F.col("seq") == F.col("c_seq"))).drop("c_part", "c_seq", "matrix")
    names = joined.columns

    def run(batches):
        for b in batches:
            found = [[unroll(s, tuple(c), state, last) for state in range(4)] for s, c, last in zip(*(b.column(names.index(n)).to_pylist() for n in ("symbols", "costs", "final")))]
            audits, exits = ([[x[i] for x in four] for four in found] for i in range(2))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int64()))], names=[*names, "audits", "exits"])

    return joined.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in joined.dtypes) + ", audits array<string>, exits array<long>")


def _forward(unrolled: DataFrame) -> DataFrame:
    """(part, seq, audit, entry): the edits of each block and the state before it, from the conversation's first block to its last."""
    rows = _in_order(unrolled).select("conv", "part", "seq", "audits", "exits")

    def run(batches):
        conv, state = object(), 0
        for b in batches:
            out = []
            for new, part, seq, audits, exits in zip(*(c.to_pylist() for c in b.columns)):
                if new != conv:
                    conv, state = new, 0
                out.append((part, seq, audits[state], state))
                state = exits[state]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, types)], names=["e_part", "e_seq", "audit", "entry"])

    return rows.mapInArrow(run, "e_part long, e_seq long, audit string, entry long")


def _texts(blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    """Blocks as the text of their repaired rows."""
    joined = blocks.join(chosen, (F.col("part") == F.col("e_part")) & (F.col("seq") == F.col("e_seq"))).select("part", "seq", "audit", "rows.role", "rows.text", "entry")

    def run(batches):
        for b in batches:
            texts = ["\n".join(repaired(zip(roles, words), audit, entry)) if audit.strip("D") else None for audit, roles, words, entry in zip(*(c.to_pylist() for c in b.columns[2:]))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(texts, pa.string())], names=["t_part", "t_seq", "audit", "repaired"])

    return joined.mapInArrow(run, "t_part long, t_seq long, audit string, repaired string")


def _joined(summaries: DataFrame, texts: DataFrame) -> DataFrame:
    """One row per conversation from its blocks in order; a task holds one block and the audit."""
    names = ["first", "last", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal"]
    rows = summaries.join(texts, (F.col("part") == F.col("t_part")) & (F.col("seq") == F.col("t_seq")))
    rows = _in_order(rows.select("conv", "part", "seq", *names, "symbols", "audit", "repaired")).drop("part", "seq")

    def run(batches):
        now = None

        def result():
            now["repaired_sha256"] = now["hash"].hexdigest()
            now["audit"] = "".join(now["letters"])
            now["cost"] = now["price"]
            now["gaps"] = now["high"] - now["low"] + 1 - now["turns"] if now["low"] is not None else 0
            return now

        def table(out, kind):
            return pa.RecordBatch.from_arrays([pa.array([o[n] for o in out], t) for n, t in [("conv", kind), *ARROW]], names=["conv", *NAMES])

        kind = None
        for b in batches:
            kind, out = b.schema.field(0).type, []
            for conv, *values, symbols, audit, text in zip(*(c.to_pylist() for c in b.columns)):
                new = dict(zip(names, values))
                if now is None or conv != now["conv"]:
                    if now is not None:
                        out.append(result())
                    now = {"conv": conv, "hash": hashlib.sha256(), "begun": False, "letters": [], "price": 0, **dict.fromkeys(names, 0), "first": None, "last": None, "low": None, "high": None}
                if now["last"] is not None and new["first"] is not None:
                    now["illegal"] += illegal([now["last"], new["first"]])
                if new["low"] is not None:
                    # a turn that goes on in the next block is one turn
                    now["turns"] += new["turns"] - (new["low"] == now["high"])
                    now["low"], now["high"] = new["low"] if now["low"] is None else now["low"], new["high"]
                now["last"] = now["last"] if new["last"] is None else new["last"]
                for n in ("blank", "duplicate", "truncated", "illegal"):
                    now[n] += new[n]
                now["letters"].append(audit)
                uses = iter(symbols)
                for letter in audit:
                    symbol = next(uses) if letter != "I" else ""
                    now["price"] += RULE_COSTS[letter] + (CUT_COST if symbol.isupper() and letter != "D" else 0)
                if text is not None:
                    now["hash"].update((("\n" if now["begun"] else "") + text).encode())
                    now["begun"] = True
            if out:
                yield table(out, kind)
        if now is not None:
            yield table([result()], kind)

    return rows.mapInArrow(run, f"conv {_type(summaries, 'conv')}, {RESULT}")


def repair(damaged: DataFrame, max_rows: int = ROWS, max_chars: int = CHARS) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of conversations (conv, turn, role, text).

    Rows are taken by turn, nulls first, those of one turn by role, first 64 characters and hash of the text.  A row with a null text is
    dropped, but its conversation is returned: without other rows it has zeros, no edits and the hash of an empty string.  Rows with
    a null conversation are one conversation; no rows give none.

    Conversations inside a block are repaired where they are read.  Larger ones are cut into blocks: min-plus matrices of the blocks give the
    costs after each, from the last to the first; the edits of all blocks are then unrolled in parallel from every state, and the states
    that are met are followed from the first to the last.  What passes from block to block is a few numbers; the
    audit and the hash, which are one value per conversation, are put together block by block.
    """
    found = store(_sorted_blocks(damaged, max_rows, max_chars))
    done = found.filter("done").select("conv", *NAMES)
    blocks = found.filter("not done").select("conv", "part", "seq", "rows")
    lines = blocks.select("conv", "part", "seq", F.posexplode("rows").alias("i", "row")).filter("row.tail <> ''")
    lines = store(lines.select("conv", "part", "seq", "i", F.sha2(F.concat(F.sha2("row.role", 256), "row.text"), 256).alias("digest")))
    # equal rows: all but the first, by block and place
    firsts = lines.groupBy(F.col("conv").alias("f_conv"), F.col("digest").alias("f_digest")).agg(F.min(F.struct("part", "seq", "i")).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = lines.join(firsts, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("digest") == F.col("f_digest"))).filter(F.struct("part", "seq", "i") != F.col("f"))
    duplicates = again.groupBy(F.col("part").alias("d_part"), F.col("seq").alias("d_seq")).agg(F.collect_list("i").alias("again"))  # at most a block's rows
    summaries = store(_summaries(blocks, duplicates))
    unrolled = store(_unrolled(summaries, _backward(summaries)))
    joined = _joined(unrolled, _texts(blocks, _forward(unrolled)))
    return done.unionByName(joined)
