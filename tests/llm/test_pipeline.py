import hashlib
from collections import defaultdict

import corpus_pipeline
from ledgerlift.llm import language_id, secrets
from ledgerlift.llm.queries import ORACLES, QUERIES
from tests.llm import oracle

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, before, SMALL), f"test-{name}")
        assert after.columns == columns
        if name in ("language", "near_dedup"):
            assert after.join(before, "doc_id", "left_anti").count() == 0 < after.count() <= before.count()
        if name == "secrets":
            assert after.count() == before.count()
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL).collect()
    count = lambda rows: sorted(w for r in rows for w in r["text"].split())
    assert count(packed) == count(before.collect())


def test_run_reruns_alike(spark):
    digest = lambda: sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in corpus_pipeline.run(spark, SMALL).collect())
    assert digest() == digest()


def test_odd_documents_go_through(odd, spark, monkeypatch):
    now = odd
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SMALL)
    now.collect()


def test_registry():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def small_documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_near_dedup_stage_equals_brute_force(spark):
    docs = small_documents(spark)
    rows = [tuple(r) for r in docs.collect()]
    ids, prints = [r[0] for r in rows], [oracle.fingerprint(r[1], 3) for r in rows]
    want = sorted(r for r, root in zip(rows, oracle.groups(ids, prints, 3)) if r[0] == root)
    got = sorted(tuple(r) for r in corpus_pipeline.dedup_stage(spark, docs, SMALL).collect())
    assert got == want and len(want) < len(rows)


def test_secrets_stage_equals_the_plain_version(spark):
    """Every value's owners and repositories counted in plain Python, every text masked by itself."""
    docs = small_documents(spark)
    rows = [r.asDict() for r in docs.collect()]
    owners, repos, assigned, spans = defaultdict(set), defaultdict(set), set(), {}
    for at, r in enumerate(rows):
        text = r["text"] or ""
        base = secrets.base_spans(text)
        covered = {i for a, _, b, _, _ in base for i in range(a, b)}
        opaque = [(m.start(), m.end()) for m in secrets.OPAQUE.finditer(text) if not set(range(m.start(), m.end())) <= covered]
        spans[at] = [(k, x, y) for _, k, _, x, y in base] + [(3, a, b) for a, b in opaque]
        for kind, a, b in spans[at]:
            owners[text[a:b]].add((r["source"] or "").split("/")[0])
            repos[text[a:b]].add(r["source"])
            assigned |= {text[a:b]} if kind < 2 else set()
    changed = 0
    want = []
    for at, r in enumerate(rows):
        text, cuts = r["text"] or "", set()
        for kind, a, b in spans[at]:
            value = text[a:b]
            few = len(owners[value]) <= secrets.MAX_OWNERS and len(repos[value]) <= secrets.MAX_REPOS
            if kind < 3 or (few and (secrets.looks_random(value) or value in assigned)):
                cuts |= set(range(a, b))
        masked = "".join(secrets.MASK if i in cuts and i - 1 not in cuts else "" if i in cuts else c for i, c in enumerate(text))
        if cuts:
            changed += 1
            r = r | {"text": masked, "n_chars": len(masked)}
        want.append(tuple(r.values()))
    got = sorted(map(str, (tuple(r) for r in corpus_pipeline.secrets_stage(spark, docs, SMALL).collect())))
    assert got == sorted(map(str, want)) and changed > 3


def test_language_stage_keeps_what_is_accepted(spark):
    docs = small_documents(spark)
    found = language_id.identified(docs.select("doc_id", "text"), language_id.learned(docs)).collect()
    want = {r["doc_id"]: r["lang_pred"] for r in found if r["lang_pred"] != "und" and r["score"] >= language_id.MIN_SCORE and r["margin"] >= language_id.MIN_MARGIN}
    got = corpus_pipeline.language_stage(spark, docs, SMALL).collect()
    assert {r["doc_id"]: r["lang"] for r in got} == want
    texts = {r["doc_id"]: (r["text"], r["source"], r["n_chars"]) for r in docs.collect()}
    assert all((r["text"], r["source"], r["n_chars"]) == texts[r["doc_id"]] for r in got)


def test_columns_of_any_name_go_through_the_stages(odd, spark):
    """What an operator calls its own columns is no matter: theirs keep their values."""
    extra = {str(tuple(r)[5:]) for r in odd.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, odd, SMALL)
        assert after.columns == odd.columns
        rows = after.collect()
        assert rows and {str(tuple(r)[5:]) for r in rows} == extra, name
