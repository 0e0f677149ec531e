"""Every stage of the pipeline against a brute-force version, on its own input."""

import collections

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from shelfwise.llm import shared  # noqa: E402

from .test_operators import brute_groups, brute_rules, brute_spans, corpus, item_words, split_words  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    texts = [t for _, t in corpus(12, 80)] + ["solo " + " ".join(f"w{k}x{j}" for j in range(60)) for k in range(20)]
    rows = [(k, t, "en", f"src{k % 2}", len(t or "")) for k, t in enumerate(texts)]
    items = [(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), items


def test_stages(spark, tables, tmp_path):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{k}")
        before, after = [(r.doc_id, r.text) for r in docs.collect()], spark.read.parquet(f"{tmp_path}/{k}").collect()
        check(k, before, after, items)
        docs = spark.read.parquet(f"{tmp_path}/{k}")


def check(k, before, after, items):
    if k == 0:
        passed = {d for d, t in before if (r := brute_rules(t))[0] >= 20 and 100 * r[4] <= 30 * r[0]}
        assert {r.doc_id for r in after} <= passed
        # no line of this corpus stands in enough documents of its host
        assert {r.doc_id for r in after} == passed and {(r.doc_id, r.text) for r in after} <= set(before)
    elif k == 1:
        groups = brute_groups(before, 5, 80)
        assert {r.doc_id for r in after} == {c for _, _, c in groups}
    elif k == 2:
        spans = {s[0]: s for s in brute_spans(before, 400)}
        texts = dict(before)
        assert len(after) == len(before)
        for r in after:
            _, n, removed, _, _ = spans[r.doc_id]
            assert len(r.text.encode()) >= n - removed and (removed or r.text == texts[r.doc_id]) and r.n_chars == len(r.text)
    elif k == 3:
        windows = {tuple(w[j : j + 13]) for _, t in items for w in [item_words(t)] for j in range(len(w) - 12)}

        def dirty(text):
            words = item_words(text)
            hit = {p for j in range(len(words) - 12) if tuple(words[j : j + 13]) in windows for p in range(j, j + 13)}
            return len(hit) > 0 and 20 * len(hit) >= len(words)

        assert {r.doc_id for r in after} == {d for d, t in before if not dirty(t)} and any(dirty(t) for _, t in before)
    else:
        assert {r.doc_id for r in after} == {d for d, _ in before} and all(r.lossless for r in after)
        assert all(r.n_ids == len(r.ids) >= len(split_words(dict(before)[r.doc_id])) for r in after)


def test_run_keeps_stages(spark, tables):
    out = corpus_pipeline.run(spark, tables[0])
    assert out.count() == len({r.doc_id for r in out.collect()}) > 0
    assert collections.Counter(len(s) for s in corpus_pipeline.STAGES) == {2: 5}


def test_run_deletes_what_it_will_not_read_again(spark, tables, tmp_path, monkeypatch):
    """Texts, blocks and edges of the join, and each stage's table once the next one is written."""
    made = []

    def fresh_dir(session, label):
        made.append(label)
        return f"file://{tmp_path}/{label}-{len(made)}"

    monkeypatch.setattr(shared, "fresh_dir", fresh_dir)
    out = corpus_pipeline.run(spark, tables[0])
    left = [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()]
    assert {"chosen", "blocks", "signatures", "wanted"} <= set(made) and not {"chosen", "blocks", "signatures", "wanted"} & set(left)
    assert made.count("stage") == 4 and left.count("stage") == 1
    assert out.count() > 0
