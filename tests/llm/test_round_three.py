"""Ball k-means, token counts and turn repair against brute force, edge cases included."""

import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

pieces_file = pytest.importorskip("public_tokenizers").path

from shelfwise.llm import ball_clusters, token_counts, turn_repair  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, distance string, cluster string"


# 11 ----------------------------------------------------------------------------------------


def plain_kmeans(rows, k, rounds, length):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v, *_ in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    drawn = lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (drawn(r), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        groups = [[v for (_, v), o in zip(kept, own) if o == j] for j in range(len(centres))]
        centres = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centres)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    total = [sum(d for _, j, d in found if j == c) for c in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, j, d, total[j], sum(total), sha[j]) for i, j, d in found]


def clumps(rng, n, length, spread):
    """Vectors in clumps, of whole sixteenths, so that equal distances and equal vectors occur."""
    middles = [[rng.randint(-40, 40) for _ in range(length)] for _ in range(5)]
    return [(k, [(m + rng.randint(-spread, spread)) / 16 for m in rng.choice(middles)]) for k in range(n)]


@pytest.mark.parametrize("length, spread, k", [(3, 1, 8), (6, 8, 8), (2, 30, 4), (1, 2, 8)])
def test_balls_give_what_comparing_all_gives(spark, length, spread, k):
    rows = [(*r, "x", "y") for r in clumps(random.Random(length), 300, length, spread)]
    rows += [(900, None, "", ""), (901, [1.0] * (length + 1), "", ""), (902, [float("nan")] * length, "", ""), (903, [float("-inf")] * length, "", ""), (904, [None] * length, "", ""), (905, [], "", ""), (None, [0.5] * length, "", ""), rows[3], rows[3]]
    found = ball_clusters.ball_kmeans(spark.createDataFrame(rows, VECTORS), k=k, length=length)
    got = [tuple(r) for r in found.members().collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(plain_kmeans(rows, k, 10, length), key=key)
    assert sum(found.counts) == len(got)


def test_the_stable_core_and_far_centroids_are_not_compared():
    rng = np.random.default_rng(2)
    middles = np.array([[0, 0], [10_000, 0], [0, 10_000], [10_000, 10_000]], float)
    own = rng.integers(0, 4, 1000)
    x = np.floor(middles[own] + rng.normal(0, 100, (1000, 2)))
    new, d, compared = ball_clusters.settle(x, own, middles)
    assert (new == own).all() and compared == 1000
    x[:10] = [5_000, 5_000]
    new, d, compared = ball_clusters.settle(x, own, middles)
    assert (new[:10] == 0).all() and 1000 < compared < 1000 + 4 * 10


def test_components_beyond_doubles_are_exact(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [70000.5, 1.0]), (4, [70001.5, 1.0])]
    found = {r["vec_id"]: r for r in ball_clusters.ball_kmeans(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=2, rounds=1, length=2).members().collect()}
    assert set(found) == {1, 2, 3, 4} and all(r["distance"] <= (1 << 63) - 1 for r in found.values())


def test_fewer_vectors_than_clusters_and_none(spark):
    few = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["vec_id"], r["cluster"], r["distance"]) for r in ball_clusters.ball_kmeans(few, length=2).members().orderBy("vec_id").collect()] == [(1, 0, 0), (2, 0, 0)]
    none = ball_clusters.ball_kmeans(few.limit(0), length=2).members()
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


# 12 ----------------------------------------------------------------------------------------

ODD = ["", None, " ", "  ", "a  b", "   lead", "trail  ", "x\n\ny z", "▁ literal ▁▁", "x▁ y", "▁", "日本語 テキスト 🎉", "tab\tsep  ", "a" * 120 + " " + "ab" * 70, "c 　　 d", "end. <|endoftext|> x", "<s> </s><unk>", "é " * 3000, "no space " * 2000 + "x" * 5000]


def texts(seed=1, n=400):
    rng = random.Random(seed)
    return ODD + ["".join(rng.choice("ab ▁\n<s>é日 ") for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("part", [1, 7, token_counts.PART])
def test_piece_counts_equal_the_library(part):
    count = token_counts.counter(pieces_file("piece_bpe_32k.model"))
    assert count.cuts
    want = [len(ids) for ids in count.library.encode([t or "" for t in texts()], num_threads=1)]
    assert count.column(pa.array(texts()), batch=200, part=part).tolist() == want


@pytest.mark.parametrize("part", [5, token_counts.PART])
def test_file_counts_equal_the_library(part):
    count = token_counts.counter(pieces_file("byte_bpe_50k.json"))
    want = [len(count.library.encode(t or "", add_special_tokens=False).ids) for t in texts()]
    assert count.column(pa.array(texts()), batch=200, part=part).tolist() == want


def test_cut_places_are_in_no_piece():
    count = token_counts.counter(pieces_file("piece_bpe_32k.model"))
    text = "plain words, and more of them\nover lines " * 50
    first, *others = count.parts(text, 64)
    assert len(others) > 10 and first + "".join(p[1:] for p in others) == text and all(p[0] == count.guard for p in others)
    assert max(map(len, others)) < 100


def test_batches_are_balanced_by_bytes():
    runs = token_counts.balanced(np.array([5, 5, 5, 100, 1, 1, 1]), 10)
    assert runs == [(0, 2), (2, 3), (3, 4), (4, 7)]
    assert token_counts.balanced(np.zeros(0, np.int64), 10) == []


def test_token_counts_of_a_table(spark):
    long = "many words in one line " * 250_000  # over SLICE bytes
    rows = [(k, t, "n", 7) for k, t in enumerate([*ODD, long])] + [(None, "a b", "n", 7), (1, "a b", "n", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int")
    library = token_counts.counter(pieces_file("piece_bpe_32k.model")).library
    got = token_counts.count_tokens(docs, pieces_file("piece_bpe_32k.model"), ["doc_id", "n_tokens"]).collect()
    want = [(k, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for k, t, *_ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert token_counts.count_tokens(docs.limit(0), pieces_file("piece_bpe_32k.model")).count() == 0


# 13 ----------------------------------------------------------------------------------------


def cheapest(sign):
    """All edits in order of cost and audit, the states being whole results."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, row, roles = heapq.heappop(heap)
        if row > len(sign):
            return cost, audit
        if (row, roles) in done:
            continue
        done.add((row, roles))
        if row == len(sign) and re.fullmatch("(s?(ua)+)?", roles):
            heapq.heappush(heap, (cost, audit, row + 1, roles))
        if row < len(sign):
            heapq.heappush(heap, (cost + 3, audit + "D", row + 1, roles))
            if sign[row] != "d":
                cut = sign[row].isupper()
                for price, edit, role in [(0, "K", sign[row].lower()), (2, "R", "u"), (2, "R", "a")]:
                    heapq.heappush(heap, (cost + cut + price, audit + edit, row + 1, roles + role))
        for role in "ua" if len(roles) < 2 * len(sign) + 2 else "":
            heapq.heappush(heap, (cost + 2, audit + "I", row, roles + role))


def test_each_signature_gets_its_cheapest_least_audit():
    rng = random.Random(4)
    signs = ["", "s", "u", "a", "ua", "sua", "uu", "aa", "dd", "oo", "UA"] + ["".join(rng.choice("suaoSUAOd") for _ in range(rng.randint(1, 5))) for _ in range(150)]
    for sign in signs:
        assert turn_repair.solve(sign) == cheapest(sign), sign
    assert turn_repair.solve("sua" + "ua" * 20_000) == (0, "K" * 40_003)


def test_segments_join_to_the_audit():
    sign = "suauudaAou"
    audit = turn_repair.solve(sign)[1]
    parts = turn_repair.segments(audit, sign, [3, 1, 4, 2])
    assert "".join(p[0] for p in parts) == audit
    assert [sum(e != "I" for e in p[0]) for p in parts] == [3, 1, 4, 2]


def plain_repair(rows):
    by_conv = {}
    for conv, turn, role, text, *_ in rows:
        own = by_conv.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        own += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        sign, seen, faults = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            core = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            sign += initial if fault is None else initial.upper() if fault == "truncated" else "d"
            if fault:
                faults[fault] += 1
            seen.add((role, text))
        turns = [t for t, *_ in own if t is not None]
        cost, audit = turn_repair.solve(sign)
        done, row = [], 0
        for edit in audit:
            due = "assistant" if done and done[-1][0][0] == "u" else "user"
            if edit == "I":
                done.append((due, ""))
                continue
            if edit != "D":
                done.append((own[row][1] if edit == "K" else due, own[row][2]))
            row += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string, run string, letters string"


def reported(df):
    return {r[0]: tuple(r[1:]) for r in turn_repair.report(df, turn_repair.Repair(turn_repair.damaged(df))).collect()}


@pytest.mark.parametrize("varied", [False, True])
def test_conversations_over_several_tasks_and_runs(spark, monkeypatch, varied):
    monkeypatch.setattr(turn_repair, "RUN_ROWS", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(5 + varied)
    said = (lambda: f"w{rng.randint(0, 900)}" + rng.choice(". !")) if varied else (lambda: rng.choice([None, "", "Hi.", "ok", "Yes!  ", "No", "x y?", " \n"]))
    rows = [(rng.choice([0, 0, 0, 0, 1, 2, None, *range(9, 30)]), rng.choice([None, *range(60)]), rng.choice(["user", "assistant", "system", None, "tool", ""]), said(), "r", "l") for _ in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    repair = turn_repair.Repair(turn_repair.damaged(df))
    assert repair.runs.select("part").distinct().count() > 1
    got = {r[0]: tuple(r[1:]) for r in turn_repair.report(df, repair).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain_repair(rows)
    # the repaired rows themselves spell the digests and the grammar
    roles = {}
    for r in sorted(repair.rows().collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["position"])):
        roles.setdefault(r["conv_id"], []).append(r)
    for conv, own in roles.items():
        assert [r["position"] for r in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in own))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in own).encode()).hexdigest() == got[conv][-1]


def test_conversations_without_rows_and_an_empty_table(spark):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi.", "r", "l"), (None, None, None, None, "r", "l"), (7, -(2**63), "user", "A.", "r", "l"), (7, 2**63 - 1, "assistant", "B." * 100_000, "r", "l")]
    got = reported(spark.createDataFrame(rows, SCHEMA))
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[7][0] == 2**63 - 1 and set(got) == {dropped, None, 7}
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in plain_repair(rows).items()}
    assert reported(spark.createDataFrame([], SCHEMA)) == {}


def test_frequent_and_rare_signatures_give_the_same(spark, monkeypatch):
    rows = [(k, t, "user" if t % 2 == 0 else "assistant", f"Said {k} {t}.", "r", "l") for k in range(300) for t in range(2 + (k % 50 == 0))]
    df = spark.createDataFrame(rows, SCHEMA)
    often = reported(df)
    monkeypatch.setattr(turn_repair, "HOT_LENGTH", 0)
    assert reported(df) == often == plain_repair(rows)


# 5, 8 --------------------------------------------------------------------------------------


def test_token_tables_refuse_narrow_ids_and_order_ties(spark, tmp_path):
    from shelfwise.llm import token_tables

    docs = spark.createDataFrame([(1, f"text {k}") for k in range(30)] + [(0, "first")], "doc_id long, text string")
    path = pieces_file("byte_bpe_50k.json")
    with pytest.raises(ValueError, match="do not fit"):
        token_tables.write_tables(docs, path, f"{tmp_path}/narrow", width=1)
    one = token_tables.write_tables(docs.repartition(7), path, f"{tmp_path}/a", shards=2)
    two = token_tables.write_tables(docs.orderBy("text", ascending=False).repartition(3), path, f"{tmp_path}/b", shards=2)
    rows = lambda m: sorted(tuple(r) for r in token_tables.read_digests(spark, m).collect())
    assert rows(one) == rows(two)


def test_benchmark_blocks_stay_small():
    import pickle

    from shelfwise.llm import decontamination

    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(20_000)]
    items = [(str(k), " ".join(rng.choice(words) for _ in range(100))) for k in range(1 << 20 >> 9)]
    size = sum(len(t) for _, t in items)
    assert 1 << 20 < size < 2 << 20 == decontamination.BLOCK_BYTES
    assert len(pickle.dumps(decontamination.item_windows(items, 13))) < 100 << 20
