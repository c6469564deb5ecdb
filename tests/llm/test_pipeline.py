"""The pipeline against a plain version over the same rows, and its stages on odd ones."""

import hashlib
import re
import zlib

import numpy as np
import regex
import tiktoken
from conftest import SF
from pyspark.sql import functions as F
from test_llm import SCHEMA, TEXTS, plain_fingerprint, plain_rules

import corpus_pipeline
import public_tokenizers
from germlight.llm import prefix_bpe, quality_classifier, quality_rules


def test_stages_call_the_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "decontamination", "encoding"]
    assert corpus_pipeline.ORACLE_SQL is None


def passes_rules(text):
    """The standard policy, condition by condition."""
    n, chars, symbols, dup, repeat = plain_rules(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    letters = [c for c in text or "" if regex.match(r"\p{L}", c)]
    upper, bangs = sum(bool(regex.match(r"\p{Lu}", c)) for c in letters), (text or "").count("!")
    failed = [
        n < 50, 100 * repeat > 50 * n, 10 * symbols > 3 * n, len(lines) >= 4 and 100 * dup > 40 * len(lines), len(letters) >= 20 and 100 * upper > 60 * len(letters),
        n > 0 and (chars < 2 * n or chars > 15 * n), 10 * bangs > 5 * n and bangs > 5,
    ]
    return not any(failed)


def direct_scores(texts, labelled):
    """P(label 1) from the two shrunk Gaussians by their definition. labelled: label -> texts."""
    x = {k: np.array([quality_classifier.statistics_of(t) for t in v]) for k, v in labelled.items()}
    n = {k: len(v) for k, v in x.items()}
    pooled = sum(n[k] * np.cov(x[k].T, bias=True) for k in x) / sum(n.values())
    z, dens = np.array([quality_classifier.statistics_of(t) for t in texts]), {}
    for k, v in x.items():
        cov = (1 - quality_classifier.TO_POOLED) * np.cov(v.T, bias=True) + quality_classifier.TO_POOLED * pooled
        cov = (1 - quality_classifier.TO_IDENTITY) * cov + quality_classifier.TO_IDENTITY * np.diag(np.maximum(np.diag(pooled), 1e-6))
        d = z - v.mean(0)
        dens[k] = np.log(n[k] / sum(n.values())) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
    return 1 / (1 + np.exp(np.clip(dens[0] - dens[1], -700, 700)))


def plain_groups(ids, texts):
    """Smallest id of each text's group: fingerprints within 4 bits, or five-word shingle sets of similarity 0.8 or more."""
    prints = [plain_fingerprint(t) for t in texts]
    grams = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        grams.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4 or (grams[i] and 5 * len(grams[i] & grams[j]) >= 4 * len(grams[i] | grams[j])):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [ids[find(i)] for i in range(len(ids))]


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def holds_window(text, windows):
    words = word_list(text)
    return any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))


def test_run_equals_plain_version(spark):
    """Every stage by its definition, in plain Python; only the statistics and constants of the classifier are the operator's."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = {k: t for k, t in docs.items() if passes_rules(t)}
    learnt = {y: [t for k, t in docs.items() if labels.get(k) == y and zlib.crc32(str(k).encode()) % 5] for y in (0, 1)}
    rows = {k: t for (k, t), p in zip(rows.items(), direct_scores(rows.values(), learnt)) if p >= 0.3}
    ids = sorted(rows)
    rows = {k: rows[k] for k, c in zip(ids, plain_groups(ids, [rows[k] for k in ids])) if k == c}
    items = [word_list(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + min(10, len(w))]) for w in items if w for i in range(len(w) - min(10, len(w)) + 1)}
    rows = {k: t for k, t in rows.items() if not holds_window(t, windows)}
    vocabulary = prefix_bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    expected = {k: hashlib.sha256(" ".join(map(str, enc.encode_ordinary(t))).encode()).hexdigest() for k, t in rows.items()}
    got = {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected and len(got) > 100


def test_documents_that_share_an_id(spark):
    """Repeated and missing ids: a contaminated or near-duplicate row takes no other row of its id with it; rows that repeat id and text are one."""
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(word_list(r["text"])) >= 12)
    dirty, others = f"before it {item} after it", [" ".join(f"{a}{i}" for i in range(60)) for a in "abcd"]
    rows = [(7, dirty), (7, others[0]), (None, dirty), (None, others[1]), (8, others[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.decontamination_stage(spark, docs, SF).collect()
    assert sorted((tuple(r) for r in left), key=repr) == sorted([rows[1], rows[3], rows[4]], key=repr)
    rows = [(7, others[0]), (7, others[1]), (9, others[0]), (None, others[1]), (None, others[2]), (7, others[0]), (None, others[2]), (None, others[3])]
    left = corpus_pipeline.near_duplicates_stage(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), SF).collect()
    assert sorted((tuple(r) for r in left), key=repr) == sorted([(7, others[0]), (7, others[1]), (None, others[2]), (None, others[3])], key=repr)


def test_decisions_join_by_shuffle_too(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = (corpus_pipeline.near_duplicates_stage, corpus_pipeline.decontamination_stage)
    one = [sorted(r["doc_id"] for r in f(spark, docs, SF).collect()) for f in stages]
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_IDS", 0)
    assert [sorted(r["doc_id"] for r in f(spark, docs, SF).collect()) for f in stages] == one


def test_stages_take_odd_rows(spark):
    data = [(i, t, "en", "s", 1, *["x" if k in (0, 2, 3, 5, 7, 9) else 1 for k in range(10)]) for i, t in enumerate(TEXTS)]
    odd = spark.createDataFrame([*data, (None, "a b", *[None] * 13), (None, None, *[None] * 13), data[4], data[11]], SCHEMA)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    one = corpus_pipeline.near_duplicates_stage(spark, odd, SF)
    texts = [r["text"] for r in one.collect()]
    assert len(texts) == len(set(texts)) and texts.count("a b") == 1 and sum(t in (None, "", TEXTS[2]) for t in texts) == 1
    assert {r["doc_id"] for r in one.where("text = 'a b'").collect()} == {4}


def test_classifier_rejects_what_passes_the_rules(spark, tmp_path):
    """Low-quality documents that no rule drops, unlabelled; all that are labelled so fail the rules, as in the given tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    words = [f"{a}{b}{c}".upper() if i % 2 else f"{c}{b}{a}" for i, (a, b, c) in enumerate((a, b, c) for a in ("th", "re", "in", "on") for b in ("eat", "ill", "ong", "und") for c in ("er", "ing", "ed", "ly"))]
    poor = [(10**6 + k, " ".join(w + "!!" if i % 5 == 0 else f"| {w}" if i % 5 == 1 else w for i, w in enumerate(words[k:] + words[:k]))) for k in range(0, 64, 21)]
    added = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in poor], "doc_id long, text string, lang string, source string, n_chars long")
    assert quality_rules.keep(added).count() == len(poor)
    docs.unionByName(added.select(*(F.col(c).cast(t) for c, t in docs.dtypes))).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    assert len(got) > 100 and not got & {k for k, _ in poor}


def test_stage_drops_similar_documents(spark):
    """177 has a 5-word Jaccard similarity of 0.83 with 1, and 9 other bits."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id IN (1, 177, 5)")
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates_stage(spark, docs, SF).collect()} == {1, 5}
