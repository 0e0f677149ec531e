"""The training-data operators against brute force on small fixtures, edge cases included."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

pieces_file = pytest.importorskip("public_tokenizers").path

from shelfwise.llm import (  # noqa: E402
    attention_lm,
    components,
    decontamination,
    html_text,
    ngram_join,
    pieces,
    quality_classifier,
    quality_rules,
    repeated_spans,
    token_tables,
    toxicity,
)

ODD = ["", None, " ", "  ", "a  b", "   lead", "trail  ", "x\n\ny z", "▁ literal ▁▁", "日本語 テキスト 🎉", "tab\tsep  ", "a" * 120 + " " + "ab" * 70, "don't  stop   now", "foo \n bar", "c 　　 d", "end. <|endoftext|> x"]
EXTRA = "doc_id long, text string, score double, n_words string, ids string, kept string, spans string"


def rng_words(rng, n):
    return [rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 60)) for _ in range(n)]


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    passages = [" ".join(rng_words(rng, 110)) for _ in range(4)]
    rows = []
    for k in range(n):
        words = rng_words(rng, rng.randint(0, 80))
        if k % 3 == 0:
            words += passages[k % 4].split()[rng.randint(0, 20) :]
        if k % 7 == 5 and rows:
            words = rows[rng.randrange(len(rows))][1].split()
            if words and k % 2:
                words[rng.randrange(len(words))] = "changed"
        rows.append((k, (" " if k % 2 else "\n").join(words)))
    return rows + [(1000, None), (1001, ""), (1002, " \n\t"), (None, rows[3][1]), (5, rows[5][1]), (1003, "long " * 4000), (1004, "one two")]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# 1 -----------------------------------------------------------------------------------------


def test_pieces_equal_the_library_without_dropout():
    import sentencepiece

    path = pieces_file("piece_bpe_32k.model")
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Model(path)
    texts = [t for t in ODD if "▁" not in (t or "")] + [t for _, t in corpus()]
    offsets, ids = pieces.encode_column(model, pa.array(texts, pa.string()), np.arange(len(texts)), dropout=0.0)
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == library.encode(text or "")


def brute_dropout(model, chunk, variant, seed, dropout):
    """The agenda one candidate at a time."""
    cps = [0x2581 if c == " " else ord(c) for c in chunk]
    offsets, ids = pieces.encode_chunks(model, [chunk], np.array([0]), np.array([variant]), seed, dropout)
    # the key is taken from the operator's own recipe; the agenda is not
    weights = pieces.mix(np.arange(1, len(cps) + 1, dtype=np.uint64))
    text_hash = (pieces.mix(np.array(cps, np.uint64) + np.uint64(7)) * weights).sum(dtype=np.uint64)
    salt = np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    key = pieces.mix(np.array([text_hash]) ^ pieces.mix(np.array([variant], np.uint64) + salt))
    spans, dead = [(k, k + 1) for k in range(len(cps))], set()
    symbols = [int(model.chars[c]) for c in cps]
    while True:
        best = None
        for k in range(len(symbols) - 1):
            cand = (spans[k][0], spans[k + 1][0], spans[k + 1][1])
            rank = int(model.ranks(np.array([symbols[k]]), np.array([symbols[k + 1]]))[0])
            if rank == pieces.NONE or cand in dead:
                continue
            if best is None or rank < best[0]:
                best = (rank, k, cand)
        if best is None:
            break
        rank, k, cand = best
        if pieces.skipped(key, [cand[0]], [cand[1]], [cand[2]], int(dropout * 2**64))[0]:
            dead.add(cand)
            continue
        symbols[k : k + 2] = [int(model.piece_of_rank[rank])]
        spans[k : k + 2] = [(spans[k][0], spans[k + 1][1])]
    return symbols, ids[offsets[0] : offsets[1]].tolist()


def test_merge_dropout_follows_the_agenda():
    model = pieces.Model(pieces_file("piece_bpe_32k.model"))
    for chunk in (" tokenization", " international", " aaaaaaaaaaaa", " " + "abandoned" * 9):
        for variant in range(4):
            expected, got = brute_dropout(model, chunk, variant, 9, 0.3)
            assert got == expected


def test_dropout_varies_and_decodes(spark):
    path = pieces_file("piece_bpe_32k.model")
    rows = [(k, t, 0.5, "x", "y", "z", "s") for k, t in enumerate(ODD)] + [(k, t, None, None, None, None, None) for k, t in corpus()]
    docs = frame(spark, rows, EXTRA)
    one = pieces.encode(docs, path, seed=1).orderBy("doc_id").toPandas()
    assert one.lossless.all() and "ids" in one and len(one) == len(rows)
    two = pieces.encode(docs, path, seed=2).toPandas()
    assert sum(map(len, one.ids)) != sum(map(len, two.ids)) or any(list(a) != list(b) for a, b in zip(one.ids, two.ids))
    back = pieces.decode(pieces.encode(docs, path, ["doc_id", "text"]), path).toPandas()
    assert (back.text.fillna("") == back.decoded).all()
    assert pieces.encode(docs.limit(0), path).count() == 0


def test_each_occurrence_has_its_own_dropout():
    """A word has more segmentations than any small number of variants, and each is that of its own key's agenda."""
    model = pieces.Model(pieces_file("piece_bpe_32k.model"))
    n, keys = 400, np.array([5, 6])
    offsets, ids = pieces.encode_column(model, pa.array(["internationalization of " * n + "aaaa" * 20] * 2), keys, 9, 0.3)
    assert pieces.decode_arrays(model, offsets, ids)[1].tobytes().decode() == ("internationalization of " * n + "aaaa" * 20) * 2
    found, expected = set(), []
    for key in keys.tolist():
        for place, chunk in enumerate([" internationalization", " of"] * n + [" " + "aaaa" * 20]):
            variant = pieces.mix(np.array([key], np.uint64) + np.array([place], np.uint64) * np.uint64(0xD1342543DE82EF95))
            _, own = pieces.encode_chunks(model, [chunk], np.array([0]), variant, 9, 0.3)
            expected += own.tolist()
            found.add((chunk, tuple(own.tolist())))
    assert ids.tolist() == expected
    assert sum(chunk == " internationalization" for chunk, _ in found) > 8


# 2 and 4 -----------------------------------------------------------------------------------


def labelled(spark, n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(n):
        words = rng_words(rng, 40)
        toxic = k % 5 == 0
        if toxic:
            words[3:3] = ["zorgblat"] * 2 + ["zorgblatting"]
        quality = k % 4 != 1
        text = " ".join(words if quality else [w + "%%%" for w in words])
        rows.append((k, text))
        labels.append((k, int(quality), int(toxic)))
    return frame(spark, rows + [(900, None), (901, ""), (None, "x y")]), frame(spark, labels + [(902, 1, None), (903, None, 1)], "doc_id long, quality int, toxic int"), labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels, known = labelled(spark)
    scorer = toxicity.fit(docs, labels.where("doc_id % 4 <> 2"))
    out = {r.doc_id: r for r in toxicity.score(docs, scorer).collect()}
    held = [(out[k].predicted, t) for k, _, t in known if k % 4 == 2]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values()) and len(out) == 403
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert toxicity.score(docs, None).agg({"score": "max"}).first()[0] == 0
    assert toxicity.score(docs.limit(0), scorer).count() == 0


def test_shared_backoff_says_nothing_of_rare_words():
    words = pa.array(["common", "zorg", "plain"], pa.string())
    raw, offsets = toxicity.flat_bytes(words)
    models = toxicity.Models(raw, offsets, np.array([[90.0, 30.0], [0.0, 12.0], [60.0, 20.0]]))
    gains, _ = models.word_gains(pa.array(["zorg", "common", "qqqq"], pa.string()))
    assert gains[0] > 3 * abs(gains[2]) and abs(gains[1]) < 0.5
    assert np.allclose(np.exp(models.context_gains).min() > 0, True)


def test_positive_unlabelled_quality(spark):
    docs, labels, known = labelled(spark)
    classifier = quality_classifier.fit(docs, labels.where("quality = 1 AND doc_id % 3 <> 1"), docs.where("doc_id % 3 <> 1").select("doc_id"))
    out = {r.doc_id: r for r in quality_classifier.score(docs, classifier).collect()}
    held = [(out[k].predicted, q) for k, q, _ in known if k % 3 == 1]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)
    assert 0.6 < classifier.prior < 0.9
    assert quality_classifier.fit(docs, labels.limit(0), docs.select("doc_id")) is None


def test_non_negative_gradient():
    rng = np.random.default_rng(0)
    p, u = rng.normal(1, 1, (60, 4)), rng.normal(0, 1, (80, 4))
    c = quality_classifier.Classifier(p, u, epochs=1)
    own_p, own_u = c.scaled(p), c.scaled(u)

    def risk():
        loss = lambda x, sign: 1 / (1 + np.exp(sign * c.forward(x)[1]))
        negative = loss(own_u, -1).mean() - c.prior * loss(own_p, -1).mean()
        return c.prior * loss(own_p, 1).mean() + negative if negative >= 0 else -negative

    grads = c.gradient(own_p, own_u)
    for k, at in ((0, (1, 2)), (1, (3,)), (2, (4,)), (3, (0,))):
        was = c.w[k][at]
        c.w[k][at] = was + 1e-5
        up = risk()
        c.w[k][at] = was - 1e-5
        down = risk()
        c.w[k][at] = was
        assert grads[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


# 3 -----------------------------------------------------------------------------------------


def split_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute_rules(text):
    words = split_words(text)
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    windows = collections.defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    covered = {p for at in windows.values() if len(at) > 1 for k in at for p in range(k, k + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng_words(rng, 30)) + "\nshared line of this host here\n" + "x#y " * (k % 9), ("a", "b", None)[k % 3], "clash") for k in range(120)]
    rows += [(200, None, "a", None), (201, "", None, None), (202, "w " * 50, "a", None), (203, "shared line of this host here\n" * 2 + "few more", "a", None), (202, "w " * 50, "a", None)]
    out = quality_rules.line_frequency(frame(spark, rows, "doc_id long, text string, source string, kept string"), least=5, with_text=True).collect()
    assert len(out) == len(rows)
    normal = lambda line: " ".join(split_words(line.lower()))
    hosts = collections.Counter(r[2] for r in rows)
    docs_with = collections.Counter((r[2], line) for r in rows for line in {normal(x) for x in (r[1] or "").split("\n")} if line)
    often = {k for k, n in docs_with.items() if n > max(5, 0.1 * hosts[k[0]])}
    for r in out:
        n, chars, symbols, dups, repeats = brute_rules(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeats)
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        gone = [x for x in (r.text or "").split("\n") if (r.source, normal(x)) in often]
        assert r.n_removed_lines == len(gone) and r.n_left == n - sum(len(split_words(x)) for x in gone)
        assert r.kept == (not r.base_failed and r.n_left >= 0.35 * n)
        assert (r.clean_text or "") == "\n".join(x for x in (r.text or "").split("\n") if (r.source, normal(x)) not in often)
    assert quality_rules.line_frequency(frame(spark, [], "doc_id long, text string, source string")).count() == 0


@pytest.mark.parametrize("arrays, rows_at_once", [(64, 200_000), (0, 200_000), (0, 0)])
def test_a_line_of_a_large_host_goes(spark, monkeypatch, arrays, rows_at_once):
    """Shared lines under a tenth of a host go with an absolute limit, by arrays, by broadcast and by shuffle."""
    monkeypatch.setattr(quality_rules, "ARRAY_LINES", arrays)
    monkeypatch.setattr(quality_rules, "BROADCAST_ROWS", rows_at_once)
    rows = [(k, f"own line {k} of it\n" + ("Shared  line" if k % 20 == 0 else f"other {k}"), "big" if k < 600 else None) for k in range(640)] + [(0, "own line 0 of it\nShared  line", "big"), (700, None, "big")]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    out = quality_rules.line_frequency(docs, with_text=True, most=25).collect()
    assert len(out) == len(rows)
    for r in out:
        gone = r.source == "big" and "Shared" in (r.text or "")
        assert r.n_removed_lines == gone and r.clean_text == (r.text.split("\n")[0] if gone else r.text)
    assert sum(r.n_removed_lines for r in out) == 31
    assert quality_rules.line_frequency(docs).where("n_removed_lines > 0").count() == 0


# 5 -----------------------------------------------------------------------------------------


def test_token_tables_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    path = pieces_file("byte_bpe_50k.json")
    rows = [(k - 3, t) for k, t in enumerate(ODD)] + corpus()
    folder = f"file://{tmp_path}/tables"
    manifest = token_tables.write_tables(frame(spark, rows), path, folder, shards=3)
    assert len(manifest) == 3 and sum(m[2] for m in manifest) == len(rows)
    got = token_tables.read_digests(spark, manifest).orderBy("start").collect()
    tokenizer, start = Tokenizer.from_file(path), 0
    tokenizer.encode_special_tokens = True
    texts = collections.defaultdict(list)
    for k, t in rows:
        texts[k].append(t)
    order = [None] + sorted(k for k in texts if k is not None)
    assert [r.doc_id for r in got] == [k for k in order for _ in texts[k]]
    expected = collections.Counter()
    for k, own in texts.items():
        for t in own:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
            expected[k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    for r in got:
        assert r.start == start
        start += r.n_tokens
    found = token_tables.lookup(spark, manifest, [5, 7, 99_999]).collect()
    assert sorted(r.key for r in found) == [5, 5, 5, 7, 7][: len(found)] or {r.key for r in found} == {5, 7}
    assert token_tables.write_tables(frame(spark, []), path, folder + "-none") == []
    assert token_tables.read_digests(spark, []).count() == 0


def test_shard_blocks_and_bloom(tmp_path):
    uri = f"file://{tmp_path}/one.sst"
    writer = token_tables.ShardWriter(uri, 2)
    rng = np.random.default_rng(1)
    values = {f"key-{k:05d}": rng.integers(0, 50_000, 400).astype("<u2").tobytes() for k in range(2_000)}
    for key, value in values.items():
        writer.add(token_tables.key_bytes(key), value)
    writer.close()
    reader = token_tables.ShardReader(uri)
    assert len(reader.blocks) > 3
    assert [(token_tables.key_value(k, False), v) for k, v in reader] == list(values.items())
    assert reader.get(token_tables.key_bytes("key-01234")) == [values["key-01234"]]
    assert not any(reader.get(token_tables.key_bytes(f"none-{k}")) for k in range(200))


# 6 -----------------------------------------------------------------------------------------


def brute_spans(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        mask = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                mask[k : k + length] = b"\1" * length
        runs = sum(m and (k == 0 or not mask[k - 1]) for k, m in enumerate(mask))
        out.append((d, len(b), sum(mask), runs, hashlib.sha256(bytes(c for c, m in zip(b, mask) if not m)).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("hot", [2_000, 1])
def test_repeated_spans(spark, hot):
    rows = corpus() + [(1010, "é" * 700), (1011, "ab" * 450), (1012, "é" * 200 + "x" * 90)]
    got = repeated_spans.remove_repeats(frame(spark, rows), ["doc_id"], hot=hot).collect()
    assert collections.Counter(map(tuple, got)) == brute_spans(rows, 400)


def test_repeated_spans_cut_whole_characters(spark):
    rows = [(1, "x" + "é" * 300 + "à"), (2, "é" * 300 + "è tail")]
    out = {r.doc_id: r.text for r in repeated_spans.remove_repeats(frame(spark, rows), with_text=True).collect()}
    assert out[2].endswith("è tail") and out[1].startswith("x") and out[1].endswith("à")
    assert repeated_spans.remove_repeats(frame(spark, [])).count() == 0


def test_suffix_sort_orders_buckets():
    rng = np.random.default_rng(4)
    raw = rng.integers(97, 99, 3_000).astype(np.uint8)
    raw[1500:2200] = raw[100:800]
    places = np.arange(0, 2_500)
    bucket = rng.integers(0, 5, len(places))
    suffixes = repeated_spans.Suffixes(raw, 60, repeated_spans.Powers())
    got, of = suffixes.sort(places, bucket)
    data = raw.tobytes()
    for b in range(5):
        own = [data[p : p + 60] for p in got[of == b]]
        assert own == sorted(own) and sorted(got[of == b]) == places[bucket == b].tolist()


# 7 -----------------------------------------------------------------------------------------


def brute_groups(rows, size, percent):
    sets = []
    for d, t in rows:
        words = split_words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append((d, {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()))
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    lowest = {}
    for k, (d, _) in enumerate(sets):
        if d is not None:
            lowest[find(k)] = min(d, lowest.get(find(k), d))
    return collections.Counter((d, len(s), lowest.get(find(k)) if s else d) for k, (d, s) in enumerate(sets))


@pytest.mark.parametrize("size,percent,block,hot", [(4, 85, 4_000_000, 64), (5, 80, 4_000_000, 2), (3, 50, 60, 4)])
def test_ngram_join(spark, monkeypatch, size, percent, block, hot):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    rng = random.Random(8)
    rows = corpus(9, 90)
    base = rng_words(rng, 150)
    for k in range(30):
        words = list(base)
        for _ in range(k // 4):
            words[rng.randrange(150)] = f"new{k}"
        rows.append((3_000 + k, " ".join(words).upper() if k % 2 else " ".join(words)))
    got = ngram_join.near_duplicates(frame(spark, rows), size=size, percent=percent, block_tokens=block).collect()
    assert collections.Counter(map(tuple, got)) == brute_groups(rows, size, percent)


def test_sets_of_a_cut_block_go_where_their_partners_are(spark, monkeypatch):
    """Texts with passages in common are one block of many parts; their sets go to no parts without partners."""
    moved = []
    real = ngram_join.part_links

    def part_links(rows, *rest):
        moved.append(rows.count())
        return real(rows, *rest)

    monkeypatch.setattr(ngram_join, "part_links", part_links)
    passages = [[f"p{k}x{j}" for j in range(40)] for k in range(6)]
    rows = []
    for k in range(60):
        words = [*passages[k % 6], *passages[(k + 1 + k // 6 % 5) % 6], *(f"q{k}x{j}" for j in range(20))]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:-1], f"new{k}"]))]
    got = ngram_join.near_duplicates(frame(spark, rows), size=4, percent=85, block_tokens=1_000).collect()
    assert collections.Counter(map(tuple, got)) == brute_groups(rows, 4, 85)
    every, _, met = moved
    assert every >= 100 and met <= 2 * every


def test_ngram_join_of_nothing(spark):
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0
    out = ngram_join.near_duplicates(frame(spark, [(1, None), (2, ""), (3, "alone")])).collect()
    assert {tuple(r) for r in out} == {(1, 0, 1), (2, 0, 2), (3, 1, 3)}


def test_signatures_meet_for_every_linked_pair():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(6, 300))
        one = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        other = np.unique(np.concatenate([one[rng.random(len(one)) > rng.random() * 0.17], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 7))).astype(np.uint64)]))
        both = len(np.intersect1d(one, other))
        if np.array_equal(one, other) or 100 * both < 85 * (len(one) + len(other) - both):
            continue
        pairs, bare, _ = ngram_join.signatures(np.concatenate([one, other]), np.array([0, len(one), len(one) + len(other)]), np.array([2, 4], np.uint64), 85)
        met = np.intersect1d(pairs["sig"][pairs["node"] == 2], pairs["sig"][pairs["node"] == 4])
        levels, counts = np.unique(met & np.uint64((1 << ngram_join.LEVEL_BITS) - 1), return_counts=True)
        _, equal, empty = ngram_join.level_parts(85)
        assert any(n >= (equal - empty)[int(k)] for k, n in zip(levels, counts)) or (len(met) and len(bare))


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(7, None)]
    got = {r.node: r.label for r in components.components(frame(spark, edges, "a long, b long")).collect()}
    parent = {}

    def find(k):
        parent.setdefault(k, k)
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        if b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {k: find(k) for k in parent}


# 8 -----------------------------------------------------------------------------------------


def item_words(text):
    out, word = [], bytearray()
    for b in (text or "").encode() + b" ":
        b = b + 32 if 65 <= b <= 90 else b
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            word.append(b)
        elif word:
            out.append(bytes(word))
            word = bytearray()
    return out


@pytest.mark.parametrize("block", [64 << 20, 200])
def test_decontamination(spark, block):
    rng = random.Random(2)
    items = [(f"i{k}", " ".join(rng_words(rng, rng.choice([3, 13, 20, 40])))) for k in range(12)] + [("none", None), ("empty", "!?"), ("i3", "same id"), (None, "null id words")]
    rows = [(k, " ".join(rng_words(rng, 20) + items[k % 12][1].upper().split(" ")[: 10 + k] + rng_words(rng, 9))) for k in range(40)]
    rows += [(90, None), (91, ""), (92, "same id"), (93, "Null-ID, words"), (None, items[1][1]), (4, rows[4][1]), (94, "été " * 30)]
    docs = frame(spark, [(*r, "x") for r in rows], "doc_id long, text string, items string")
    out = decontamination.decontaminate(docs, frame(spark, items, "item_id string, text string"), ["doc_id", "text"], block_bytes=block, with_text=True).collect()
    assert len(out) == len(rows)
    windows = []
    for name, text in items:
        w = item_words(text)
        n = min(13, len(w))
        windows += [(name or "", w[k : k + n]) for k in range(len(w) - n + 1) if n]
    for r in out:
        words, hit, names = item_words(r.text), set(), set()
        for name, w in windows:
            for k in range(len(words) - len(w) + 1):
                if words[k : k + len(w)] == w:
                    hit |= set(range(k, k + len(w)))
                    names.add(name)
        assert (r.n_words, r.n_hit, sorted(r["items"])) == (len(words), len(hit), sorted(names))
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))
        assert item_words(r.kept_text) == [w for k, w in enumerate(words) if k not in hit]
    assert not any(r.n_hit for r in decontamination.decontaminate(docs, frame(spark, [], "item_id string, text string")).collect())


# 9 -----------------------------------------------------------------------------------------

PAGE = """<html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href=x>Home</a><li><a>About</a></ul></nav><!-- note --><div class="cookie-notice">We use cookies</div>
%s<div class="ad">Buy now</div><aside>Side</aside><form><p>Mail</p><input></form><section id="comments"><p>First!</p></section><footer>&copy; all</footer></body></html>"""


def test_main_text():
    article = "<article><h1>A  title</h1><p>First &amp; <b>bold\n text</b><br>more words go here.<p>Ok.<div class='ad'>Spam</div><ul><li>One<li>Two</ul></article>"
    assert html_text.main_text(PAGE % article) == "A title\n\nFirst & bold text more words go here.\n\nOk.\n\nOne\n\nTwo"
    long = "Some long running text that goes on for a while, as the text of an article does. " * 3
    plain = f"<div id=content><p>{long}</p><p>Short.</p><p>{long}</p></div>"
    assert html_text.main_text(PAGE % plain) == "\n\n".join([long.strip(), "Short.", long.strip()])
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>x</script>") == ""
    assert html_text.main_text("only text") == "only text"
    assert html_text.main_text("<p>unclosed <b>one<p>two") == "unclosed one\n\ntwo"


def test_main_text_frame(spark):
    pages = frame(spark, [(1, "u", "<article><p>é</p></article>", "x"), (2, None, None, None), (1, "u", "<article><p>é</p></article>", "x")], "page_id long, url string, html string, text string")
    assert [tuple(r) for r in html_text.extract(pages, ["page_id", "url"]).orderBy("page_id").collect()] == [(1, "u", "é", 1), (1, "u", "é", 1), (2, None, "", 0)]


# 10 ----------------------------------------------------------------------------------------


def test_attention_lm(spark, monkeypatch):
    monkeypatch.setattr(attention_lm.Attention.train, "__defaults__", (60, 32))
    rows = [(k, t, k % 7 != 2) for k, t in corpus() if k is not None] + [(k + 500, t, True) for k, t in enumerate(ODD)]
    docs = frame(spark, rows, "doc_id long, text string, train boolean")
    path = pieces_file("piece_bpe_32k.model")
    counts = collections.Counter()
    low = lambda t: [w for w in split_words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))] + [None]
    for _, t, train in rows:
        if train:
            counts.update(low(t))
    total, kinds = sum(counts.values()), len(counts)
    results = []
    for limit in (attention_lm.BROADCAST_WORDS, 3):
        out = attention_lm.score(docs, "train", path, ["doc_id", "text"], broadcast_words=limit).collect()
        assert len(out) == len(rows)
        for r in out:
            words = low(r.text)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), total)
            assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words), rel=1e-9)
            assert r.score < 0
        results.append({(r.doc_id, r.text): r.score for r in out})
    for k, v in results[0].items():
        assert results[1][k] == pytest.approx(v, rel=1e-4)


def test_attention_lm_learns_from_every_text(spark, monkeypatch):
    """Texts that the first sample bars, as they are longer than a tenth of its bytes, are learnt from."""
    monkeypatch.setattr(attention_lm, "TRAIN_BYTES", 10_000)
    monkeypatch.setattr(attention_lm, "ROUND_BATCH", 4)
    rng = random.Random(4)
    cycle = "red green blue black white brown grey pink"
    rows = [(k, " ".join([cycle] * 300), True) for k in range(40)]
    rows += [(100, " ".join([cycle] * 5), False), (101, " ".join(rng.sample(cycle.split() * 5, 40)), False)]
    docs = frame(spark, rows, "doc_id long, text string, train boolean")
    out = {r.doc_id: r.score for r in attention_lm.score(docs, "train", pieces_file("piece_bpe_32k.model"), ["doc_id"]).where("doc_id >= 100").collect()}
    # the order of words, which no count of single ids has, is known
    assert out[100] > 0.7 * out[101], out


def test_windows_score_each_token_once():
    model = pieces.Model(pieces_file("piece_bpe_32k.model"))
    offsets, ids = np.array([0, 0, 5, 105]), np.arange(105) % 7 + 300
    classes = attention_lm.Classes(offsets, ids, model.size)
    inputs, targets, row = attention_lm.windows_of(classes, offsets, classes.of[ids])
    assert [(targets[row == k] >= 0).sum() for k in range(3)] == [1, 6, 101]
    net = attention_lm.Attention(classes)
    hidden = net.hidden(inputs)[0]
    # a later token changes no earlier place
    changed = inputs.copy()
    changed[-1, -1] = 5
    assert np.allclose(net.hidden(changed)[0][:, :-1], hidden[:, :-1])
    assert np.abs(net.fast_hidden(inputs, net.ready()) - hidden.reshape(-1, attention_lm.WIDTH))[targets.ravel() >= 0].max() < 1e-4
    # probabilities of all classes add up to one
    one, last = hidden.reshape(-1, attention_lm.WIDTH)[26:27], inputs[:, attention_lm.OVERLAP :].ravel()[26:27]
    every = net.groups * net.members
    assert np.exp(net.log_probs(np.repeat(one, every, 0), np.repeat(last, every), np.arange(every))).sum() == pytest.approx(1, abs=1e-5)


def test_scores_equal_a_plain_version():
    """Place by place in double precision; and windows take two bytes an id."""
    model = pieces.Model(pieces_file("piece_bpe_32k.model"))
    rng = np.random.default_rng(3)
    offsets = np.array([0, 0, 1, 31, 63, 96, 200])
    ids = rng.integers(300, 900, 200)
    classes = attention_lm.Classes(offsets, ids, model.size)
    net = attention_lm.Attention(classes)
    net.prior(np.append(np.bincount(classes.of[ids], minlength=classes.end), 6))
    net.w |= {k: (x + rng.normal(0, 0.3, x.shape)).astype(np.float32) for k, x in net.w.items() if k != "const"}
    w, stride, overlap = {k: x.astype(float) for k, x in net.w.items()}, attention_lm.STRIDE, attention_lm.OVERLAP
    distance = w["distance"].ravel()
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for scale in (1, 40):  # with larger keys, exponentials leave the range of their type
        net.w["k"] = (w["k"] * scale).astype(np.float32)
        found = net.log10(offsets, classes.of[ids])
        for row in range(len(offsets) - 1):
            text = [classes.bos, *classes.of[ids[offsets[row] : offsets[row + 1]]], classes.end]
            total = 0.0
            for at in range(len(text) - 1):
                first = max(0, at // stride * stride - overlap)
                x = w["emb"][text[first : at + 1]]
                weights = softmax(x @ w["k"] @ (x[-1] @ w["q"]) * scale / attention_lm.KEY**0.5 + distance[: len(x)][::-1])
                h = np.tanh(x[-1] @ w["self"] + weights @ (x @ w["v"]) @ w["out"] + w["bias"])
                group, member = divmod(int(text[at + 1]), net.members)
                total += np.log10(softmax(h @ w["group_up"] + w["group_next"][text[at]] + w["group_const"])[group])
                total += np.log10(softmax(h @ w["up"][group] + w["next"][group][text[at]] + w["const"][group])[member])
            assert found[row] == pytest.approx(total, rel=1e-4, abs=1e-3), (scale, row)
    assert [x.itemsize for x in attention_lm.windows_of(classes, offsets, classes.of[ids])[:2]] == [2, 2]


def test_attention_gradient():
    model = pieces.Model(pieces_file("piece_bpe_32k.model"))
    offsets, ids = np.array([0, 70, 100]), np.arange(100) ** 2 % 11 + 300
    classes = attention_lm.Classes(offsets, ids, model.size)
    inputs, targets, _ = attention_lm.windows_of(classes, offsets, classes.of[ids])
    net = attention_lm.Attention(classes)
    net.w = {k: x.astype(np.float64) for k, x in net.w.items()}
    _, g = net.gradient(inputs, targets)
    for name, x in net.w.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), x.shape)
        was, step = x[at], 1e-3
        x[at] = was + step
        up, _ = net.gradient(inputs, targets)
        x[at] = was - step
        down, _ = net.gradient(inputs, targets)
        x[at] = was
        assert g[name][at] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=1e-5), name
