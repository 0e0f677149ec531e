"""Repair of the structure of conversations by solving each signature once.

Rows are sorted by conversation and turn over ranges, so a long conversation is
spread over tasks. A task packs its rows into runs: up to RUN_ROWS rows of one
conversation in order, with one letter for each row. The letter tells what an
edit may do with it: the role's initial (s, u, a, or o for any other), a capital
if the text is truncated, d if the row is blank or a duplicate and has to go.
Duplicates across tasks are found by digest, and only for conversations that
reach over more than one task. The letters of a conversation make its signature.

Each distinct signature is solved once, by memoised recursion over (row, state,
insertions left): the cheapest edits after which the initials read
(s?(ua)+)?, ties by the ASCII-least audit. From a state each edit leads to one
other state, so the least letter among the cheapest is the least audit. Audits
are joined back by signature; signatures of many conversations travel as a
broadcast of at most HOT_ROWS rows and HOT_LENGTH letters, so none of them is a
hot key. Edits are replayed run by run.

What no plan can spread is a digest over a whole conversation, as it is one
sequence: runs of conversations with several runs meet in one task, in order,
one run in memory at a time. Signatures are strings, so a conversation has at
most 2**31 rows.

Edge cases: null roles and texts are one space (a blank row goes); rows without
a turn come first; rows of one turn are ordered by role and text; equal rows are
duplicates; a null conversation is a conversation; an empty table gives an
empty result; extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

RUN_ROWS, RUN_BYTES = 4096, 1 << 20
#: Signatures of at least one in HOT_ROWS conversations, if no longer than HOT_LENGTH, are broadcast: at most HOT_ROWS of them.
HOT_ROWS, HOT_LENGTH = 500, 10_000
SPACES = " \t\n\v\f\r"
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
START, SYSTEM, USER, ASSISTANT = range(4)
#: What each state waits for: the state after it, and the role.
WAITS = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Rows of a signature by which the recursion is filled from the end, so that it stays shallow.
DEPTH = 100


def letter(role: str, text: str, seen: bool) -> str:
    core = text.rstrip(SPACES)
    if not core or seen:
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial if core[-1] in ".!?" else initial.upper()


def solve(signature: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, the ASCII-least of equals."""
    known: dict[tuple[int, int, int], tuple[int, str]] = {}

    def best(row: int, state: int, inserts: int) -> tuple[int, str]:
        at = (row, state, inserts)
        if at not in known:
            ways, waited = [], WAITS[state][0]
            if row == len(signature) and state in (START, ASSISTANT):
                ways.append((0, ""))
            if inserts:
                ways.append((COSTS["I"] + best(row, waited, inserts - 1)[0], "I"))
            if row < len(signature):
                sign = signature[row]
                ways.append((COSTS["D"] + best(row + 1, state, 2)[0], "D"))
                if sign != "d":
                    cut, kept = int(sign.isupper()), KEEPS.get((state, sign.lower()))
                    if kept is not None:
                        ways.append((COSTS["K"] + cut + best(row + 1, kept, 2)[0], "K"))
                    ways.append((COSTS["R"] + cut + best(row + 1, waited, 2)[0], "R"))
            known[at] = min(ways, default=(1 << 60, ""))
        return known[at]

    for row in range(len(signature), 0, -DEPTH):
        for state in WAITS:
            best(row, state, 2)
    audit, row, state, inserts = [], 0, START, 2
    while edit := best(row, state, inserts)[1]:
        audit.append(edit)
        if edit == "K":
            state = KEEPS[state, signature[row].lower()]
        elif edit != "D":
            state = WAITS[state][0]
        row, inserts = (row, inserts - 1) if edit == "I" else (row + 1, 2)
    return best(0, START, 2)[0], "".join(audit)


def segments(audit: str, signature: str, sizes: list[int]) -> list[tuple[str, int, int]]:
    """(edits, state before them, rows of the result before them) of each run of `sizes` rows; insertions go with the row they precede."""
    out, at, row, state, place = [], 0, 0, START, 0
    for k, size in enumerate(sizes):
        begin, before, first, end = at, state, place, row + size
        while at < len(audit) and (row < end or k == len(sizes) - 1):
            edit = audit[at]
            if edit == "K":
                state = KEEPS[state, signature[row].lower()]
            elif edit != "D":
                state = WAITS[state][0]
            row, place, at = row + (edit != "I"), place + (edit != "D"), at + 1
        out.append((audit[begin:at], before, first))
    return out


def replay(roles: list[str], texts: list[str], edits: str, state: int) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the rows that the edits leave or insert."""
    out, row = [], 0
    for edit in edits:
        if edit == "I":
            state, role = WAITS[state]
            out.append((edit, role, ""))
            continue
        if edit == "R":
            state, role = WAITS[state]
            out.append((edit, role, texts[row]))
        elif edit == "K":
            state = KEEPS[state, roles[row][0]]
            out.append((edit, roles[row], texts[row]))
        row += 1
    return out


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with planted faults, by crc32 of `conv:turn` modulo 20: 0 drops a row, 1 empties it, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    drawn = rows.select(F.col(conv), F.col(turn), space(role).alias(role), space(text).alias(text), fate.alias("_fate")).where("_fate <> 0")
    new_text = F.when(F.col("_fate") == 1, F.lit("")).when(F.col("_fate") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    copies = F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return drawn.select(conv, turn, F.when(F.col("_fate") == 4, F.lit("user")).otherwise(F.col(role)).alias(role), new_text.alias(text), copies.alias("_copy")).drop("_copy")


RUN = "conv {kind}, part int, run long, size int, first_turn decimal(38,0), last_turn decimal(38,0), turns int, letters string, blank long, illegal long, first_role string, last_role string, digests binary, roles array<string>, texts array<string>"


def to_runs(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Runs of consecutive rows; `run` numbers them in the order of all rows."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("decimal(38,0)").alias("turn"), space(role).alias("role"), space(text).alias("text"))
    ordered = plain.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv", "turn", "role", "text")

    def packed(part, number, own):
        conv, rows = own
        turns = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "o" for r in rows]
        return {
            "conv": conv, "part": part, "run": (part << 32) + number, "size": len(rows), "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
            "letters": "".join(r[3] for r in rows), "blank": sum(not r[2].rstrip(SPACES) for r in rows), "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "first_role": initials[0], "last_role": initials[-1], "digests": b"".join(r[4] for r in rows), "roles": [r[1] for r in rows], "texts": [r[2] for r in rows],
        }

    def run(batches):
        part, number, own, size, seen = TaskContext.get().partitionId(), 0, None, 0, set()
        for batch in batches:
            ready = []
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text"))):
                if own is None or own[0] != conv or len(own[1]) >= RUN_ROWS or size >= RUN_BYTES:
                    if own is not None:
                        ready.append(packed(part, number, own))
                        number += 1
                        if own[0] != conv:
                            seen = set()
                    own, size = (conv, []), 0
                digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(errors="surrogatepass"), digest_size=16).digest()
                own[1].append((turn, role, text, letter(role, text, digest in seen), digest))
                seen.add(digest)
                size += len(text)
            if ready:
                yield pa.RecordBatch.from_pylist(ready, kind)
        if own is not None:
            yield pa.RecordBatch.from_pylist([packed(part, number, own)], kind)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(RUN.format(kind=dict(plain.dtypes)["conv"]))
    kind = to_arrow_schema(schema)
    return ordered.mapInArrow(run, schema)


def repeats(runs: DataFrame) -> DataFrame:
    """(run, places): rows of later tasks that equal a row of an earlier task, in conversations of several tasks.

    Such conversations are at most as many as tasks, as each of them crosses a border.
    """
    crossing = runs.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select(F.col("conv").alias("_conv"))
    digests = runs.join(crossing, F.col("conv").eqNullSafe(F.col("_conv"))).select("conv", "part", "run", "letters", F.posexplode(F.sequence(F.lit(1), F.col("size"))).alias("place", "_k"), "digests")
    firsts = digests.where(F.substr("letters", F.col("_k"), F.lit(1)) != "d").select("conv", "part", "run", "place", F.substr("digests", F.col("place") * 16 + 1, F.lit(16)).alias("digest"))
    later = firsts.withColumn("_first", F.min("part").over(Window.partitionBy("conv", "digest"))).where("part > _first")
    return later.groupBy(F.col("run").alias("_run")).agg(F.collect_list("place").alias("places"))


def bordering(runs: str, condition) -> Column:
    """Number of neighbouring runs for which the condition holds."""
    pairs = F.zip_with(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.slice(runs, 2, F.size(runs)), lambda a, b: F.coalesce(condition(a, b), F.lit(False)).cast("long"))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda total, x: total + x)


def signed(runs: DataFrame) -> DataFrame:
    """conv, signature, counts and the runs' numbers and sizes: one row for each conversation with rows."""
    narrow = runs.drop("digests", "roles", "texts").join(repeats(runs), F.col("run") == F.col("_run"), "left")
    letters = F.aggregate(F.coalesce("places", F.array().cast("array<int>")), F.col("letters"), lambda own, place: F.overlay(own, F.lit("d"), place + 1, F.lit(1)))
    fields = ["run", "size", "first_turn", "last_turn", "turns", letters.alias("letters"), "blank", "illegal", "first_role", "last_role"]
    by_conv = narrow.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("r"))
    total = lambda name: F.aggregate("r", F.lit(0).cast("long"), lambda n, x: n + x[name])
    texts = by_conv.select("conv", F.array_join(F.transform("r", lambda x: x["letters"]), "").alias("signature"), F.transform("r", lambda x: x["run"]).alias("runs"), F.transform("r", lambda x: x["size"]).alias("sizes"), "r")
    last, first = F.array_max(F.transform("r", lambda x: x["last_turn"])), F.array_min(F.transform("r", lambda x: x["first_turn"]))
    turns = total("turns") - bordering("r", lambda a, b: a["last_turn"] == b["first_turn"])
    span = F.coalesce(last.cast("decimal(20,0)") - first.cast("decimal(20,0)") + 1 - turns, F.lit(0))
    gone = F.length(F.regexp_replace("signature", "[^d]", "")).cast("long")
    return texts.select(
        "conv", "signature", "runs", "sizes",
        F.least(span, F.lit((1 << 63) - 1)).cast("long").alias("gaps"), total("blank").alias("blank"), (gone - total("blank")).alias("duplicate"),
        F.length(F.regexp_replace("signature", "[^SUAO]", "")).cast("long").alias("truncated"),
        (total("illegal") + bordering("r", lambda a, b: ~F.concat(a["last_role"], b["first_role"]).isin("su", "ua", "au"))).alias("illegal"),
    )


def solved(conversations: DataFrame) -> DataFrame:
    """signature, n, cost, audit: one row for each distinct signature."""

    def run(batches):
        for batch in batches:
            found = [solve(s) for s in batch.column("signature").to_pylist()]
            yield pa.RecordBatch.from_pydict({"signature": batch.column("signature"), "n": batch.column("n"), "cost": pa.array([c for c, _ in found], pa.int64()), "audit": pa.array([a for _, a in found], pa.string())})

    return conversations.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).mapInArrow(run, "signature string, n long, cost long, audit string")


def with_audits(conversations: DataFrame, answers: DataFrame) -> DataFrame:
    """Conversations and their signature's cost and audit; frequent signatures are broadcast, the others are joined by a shuffle."""
    total = answers.agg(F.sum("n")).first()[0] or 0
    hot = (F.col("n") * HOT_ROWS >= F.lit(total)) & (F.length("signature") <= HOT_LENGTH)
    often = answers.where(hot).select(F.col("signature").alias("_sign"), F.col("cost").alias("_cost"), F.col("audit").alias("_audit"))
    joined = conversations.join(F.broadcast(often), F.col("signature") == F.col("_sign"), "left").drop("_sign")
    rest = joined.where("_cost IS NULL").drop("_cost", "_audit").join(answers.where(~hot).drop("n"), "signature")
    columns = [*conversations.columns, "cost", "audit"]
    return joined.where("_cost IS NOT NULL").withColumnsRenamed({"_cost": "cost", "_audit": "audit"}).select(columns).unionByName(rest.select(columns))


class Repair:
    """conversations: conv, signature, runs, sizes, gaps, blank, duplicate, truncated, illegal, cost, audit. rows(): the repaired rows. digests(): one hash for each conversation."""

    def __init__(self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        self.conv = conv
        self.runs = stored(to_runs(rows, conv, turn, role, text), "runs")
        signatures = stored(signed(self.runs), "signatures")
        self.answers = stored(solved(signatures), "audits")
        self.conversations = stored(with_audits(signatures, self.answers), "audited")

    def edited(self) -> DataFrame:
        """conv, run, n_runs, first (place in the result), edits, state, roles, texts."""

        def run(batches):
            for batch in batches:
                out = {c: [] for c in ("run", "n_runs", "edits", "state", "first")}
                for audit, signature, runs, sizes in zip(*(batch.column(c).to_pylist() for c in ("audit", "signature", "runs", "sizes"))):
                    for number, (edits, state, first) in zip(runs, segments(audit, signature, sizes)):
                        for name, value in zip(out, (number, len(runs), edits, state, first)):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c == "edits" else pa.int64()) for c, v in out.items()})

        pieces = self.conversations.select("audit", "signature", "runs", "sizes").mapInArrow(run, "run long, n_runs long, edits string, state long, first long")
        return self.runs.select("conv", "run", "roles", "texts").join(pieces, "run")

    def rows(self) -> DataFrame:
        """conversation, position (from 0), edit, role, text of the repaired conversations."""

        def run(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    own = {c: batch.column(c)[k].as_py() for c in ("roles", "texts", "edits", "state", "first")}
                    done = replay(own["roles"], own["texts"], own["edits"], own["state"])
                    if done:
                        edits, roles, texts = zip(*done)
                        conv = batch.column("conv").take(pa.array([k] * len(done)))
                        yield pa.RecordBatch.from_pydict({"conv": conv, "position": pa.array(range(own["first"], own["first"] + len(done)), pa.int64()), "edit": pa.array(edits), "role": pa.array(roles), "text": pa.array(texts)})

        kind = dict(self.runs.dtypes)["conv"]
        out = self.edited().mapInArrow(run, f"conv {kind}, position long, edit string, role string, text string")
        return out.withColumnRenamed("conv", self.conv)

    def digests(self) -> DataFrame:
        """conversation, repaired_sha256: lowercase hex over `role:text` of the repaired rows, joined by newlines."""

        def parts(batches):
            for batch in batches:
                hashes, texts = [], []
                for roles, own, edits, state, n_runs in zip(*(batch.column(c).to_pylist() for c in ("roles", "texts", "edits", "state", "n_runs"))):
                    done = replay(roles, own, edits, state)
                    joined = "\n".join(f"{r}:{t}" for _, r, t in done).encode(errors="surrogatepass")
                    hashes.append(hashlib.sha256(joined).hexdigest() if n_runs == 1 else None)
                    texts.append(joined if n_runs > 1 and done else None)
                yield pa.RecordBatch.from_pydict({"conv": batch.column("conv"), "run": batch.column("run"), "sha": pa.array(hashes, pa.string()), "part": pa.array(texts, pa.binary())})

        def chained(batches):
            open_, whole, empty = None, None, True
            for batch in batches:
                out = {"conv": [], "sha": []}
                for conv, sha, part in zip(*(batch.column(c).to_pylist() for c in ("conv", "sha", "part"))):
                    if sha is None and (open_ is None or open_ != (conv,)):
                        if open_ is not None:
                            out["conv"].append(open_[0])
                            out["sha"].append(whole.hexdigest())
                        open_, whole, empty = (conv,), hashlib.sha256(), True
                    if sha is not None:
                        out["conv"].append(conv)
                        out["sha"].append(sha)
                    elif part is not None:
                        whole.update(part if empty else b"\n" + part)
                        empty = False
                yield pa.RecordBatch.from_pydict({"conv": pa.array(out["conv"], batch.schema.field("conv").type), "sha": pa.array(out["sha"], pa.string())})
                kept = batch.schema.field("conv").type
            if open_ is not None:
                yield pa.RecordBatch.from_pydict({"conv": pa.array([open_[0]], kept), "sha": pa.array([whole.hexdigest()])})

        kind = dict(self.runs.dtypes)["conv"]
        pieces = self.edited().mapInArrow(parts, f"conv {kind}, run long, sha string, part binary")
        whole = pieces.repartition("conv").sortWithinPartitions("conv", "run").mapInArrow(chained, f"conv {kind}, sha string")
        return whole.select(F.col("conv").alias(self.conv), F.col("sha").alias("repaired_sha256"))


def report(original: DataFrame, repair: Repair, conv: str = "conv_id") -> DataFrame:
    """One row for each conversation of `original`: counts, cost, audit and digest; zeros, an empty audit and the hash of nothing for those without rows."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = repair.conversations.select(F.col("conv").alias("_a"), *counts, "audit")
    digests = repair.digests().select(F.col(conv).alias("_b"), "repaired_sha256")
    every = original.select(conv).distinct()
    joined = every.join(found, F.col(conv).eqNullSafe(F.col("_a")), "left").join(digests, F.col(conv).eqNullSafe(F.col("_b")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(conv, *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
