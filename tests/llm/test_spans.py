"""Planted passages on both sides of 400 bytes and of 50 words, and equal stretches in many documents."""

import collections
import hashlib
import random
import re

import corpus_pipeline
from shelfwise.llm import repeated_spans

WORDS = [a + b for a in "b c d f g l m n p r s t".split() for b in ("a", "ei", "ou", "ina", "erto")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def brute(rows, length):
    """(identifier, bytes, removed, runs, digest) by a look at every window."""
    data = [(d or "").encode() for _, d in rows]
    seen = {}
    for k, x in enumerate(data):
        for at in range(len(x) - length + 1):
            seen.setdefault(x[at : at + length], []).append((k, at))
    gone = [bytearray(len(x)) for x in data]
    for places in seen.values():
        for k, at in places if len(places) > 1 else ():
            gone[k][at : at + length] = b"\1" * length
    out = []
    for (doc, _), x, marks in zip(rows, data, gone):
        runs = sum(1 for at, m in enumerate(marks) if m and (at == 0 or not marks[at - 1]))
        out.append((doc, len(x), sum(marks), runs, hashlib.sha256(bytes(c for c, m in zip(x, marks) if not m)).hexdigest()))
    return sorted(out)


def test_passages_of_over_fifty_words_go_only_from_400_bytes_on(spark):
    rng = random.Random(5)
    passages = [prose(rng, 55)[:size] for size in (380, 399, 400, 401)] + [prose(rng, 60), prose(rng, 51)]
    rows = [(k, prose(rng, 40 + k % 30) + " " + passages[k % 6] + " " + prose(rng, 25)) for k in range(30)]
    rows += [(100 + k, prose(rng, 80)) for k in range(5)] + [(200, None), (201, "")]
    found = repeated_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    assert sorted(map(tuple, found)) == brute(rows, 400)
    removed = {r.doc_id: r.n_removed for r in found}
    # the text around a passage is not shared but for the blanks beside it
    assert all((removed[k] > 0) == (len(passages[k % 6]) >= 398) for k in range(30) if len(passages[k % 6]) not in (398, 399))
    assert all(removed[k] == 0 for k in removed if k >= 100)


def test_one_stretch_in_very_many_documents(spark):
    rng = random.Random(6)
    common = prose(rng, 90)
    rows = [(k, (prose(rng, 3) + " " if k % 2 else "") + common) for k in range(120)]
    for hot in (2, 2_000):
        found = repeated_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], hot=hot).collect()
        assert sorted(map(tuple, found)) == brute(rows, 400)


def brute_words(rows, words):
    """{identifier: marks of the words in windows that stand at two places} by a look at every window."""
    texts = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    seen = {}
    for d, own in texts.items():
        for at in range(len(own) - words + 1):
            seen.setdefault(tuple(own[at : at + words]), []).append((d, at))
    gone = {d: [False] * len(own) for d, own in texts.items()}
    for places in seen.values():
        for d, at in places if len(places) > 1 else ():
            gone[d][at : at + words] = [True] * words
    return gone


def with_passages():
    """Passages of 49 to 70 short words, some with other white space, each in three documents; then a passage twice in one text, and texts alone."""
    rng = random.Random(7)
    short = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    passages = [short(n) for n in (49, 50, 51, 55, 60, 70)]
    rows = [(k, prose(rng, 30 + k) + (" " if k % 2 else "\n") + (passages[k % 6] if k < 12 else passages[k % 6].replace(" ", " \t")) + " " + prose(rng, 20)) for k in range(18)]
    long = prose(rng, 70)
    rows += [(40 + k, f"{prose(rng, 12)} {passages[k]} {prose(rng, 12)} {long} {prose(rng, 5)}") for k in (4, 5)]
    return rows + [(50, f"{prose(rng, 9)} {passages[3]} {prose(rng, 9)} {passages[3]}"), (60, prose(rng, 90)), (61, prose(rng, 70)), (62, "é " * 120), (63, None), (64, "")]


def test_passages_of_fifty_words_are_found_under_400_bytes(spark):
    rows = with_passages()
    gone = brute_words(rows, 50)
    for hot in (1, 2_000):
        found = repeated_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], words=50, hot=hot).collect()
        assert {r.doc_id: r.n_passage_words for r in found} == {d: sum(marks) for d, marks in gone.items()}
        # what the byte strings give is as without words
        assert sorted(tuple(r)[:5] for r in found) == brute(rows, 400)
    assert all((sum(gone[k]) > 0) == (k % 6 > 0) for k in range(18)) and not sum(gone[60]) and sum(gone[62]) == 120


def test_pipeline_removes_passages_of_over_fifty_words(spark):
    rows = with_passages()
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r.text for r in corpus_pipeline.repeated_span_stage(spark, docs, "").collect()}
    data, of_words = {d: (t or "").encode() for d, t in rows}, brute_words(rows, 50)
    windows = collections.Counter(x[at : at + 400] for x in data.values() for at in range(len(x) - 399))
    both = 0
    for d, x in data.items():
        of_bytes = {p for at in range(len(x) - 399) if windows[x[at : at + 400]] > 1 for p in range(at, at + 400)}
        gone = set(of_bytes)
        places = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", x)]
        for k, out in enumerate(of_words[d]):
            if out:  # with the white space inside a passage
                gone |= set(range(places[k][0], places[k + 1][0] if of_words[d][k + 1 : k + 2] == [True] else places[k][1]))
        assert left[d].encode() == bytes(c for p, c in enumerate(x) if p not in gone)
        both += bool(of_bytes and gone - of_bytes)
    assert both >= 2 and sum(map(any, of_words.values())) > 15
