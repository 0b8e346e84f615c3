from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpus_pipeline import STAGES, run
from shelfline.llm.mixing import mix_sources
from shelfline.llm.pii import KINDS, base_spans, find_spans, fit, masked
from shelfline.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage keeps, in order, starting with the table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        f(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_all_but_the_last_return_documents(kept):
    assert [name for name, _ in STAGES] == ["language_id", "simhash_near_dedup", "personal_data", "mix_sources", "bpe"]
    assert all(df.columns == kept[0].columns and df.dtypes == kept[0].dtypes for df in kept[:-1])


def test_language_stage_keeps_documents_with_a_language(kept):
    before, after = as_rows(kept[0]), as_rows(kept[1])
    assert not Counter(after) - Counter(before)
    gone = Counter(before) - Counter(after)
    assert sum(gone.values()) <= 0.02 * len(before)


def test_one_of_each_group_stays(kept):
    rows = as_rows(kept[1])
    prints = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = defaultdict(list)
    for r, g in zip(rows, group):
        first[g].append(r)
    assert as_rows(kept[2]) == sorted((min(rs) for rs in first.values()), key=repr)


def test_personal_data_is_masked(kept):
    before = kept[2].collect()
    field = fit(kept[2])
    spans = find_spans([r.text for r in before], field)
    expected = [(r.doc_id, masked(r.text, s)) for r, (_, s) in zip(before, spans)]
    after = kept[3].collect()
    assert Counter((r.doc_id, r.text) for r in after) == Counter(expected)
    assert all(r.n_chars == len(r.text) for r in after if any(f"[{k.upper()}]" in r.text for k in KINDS))
    assert sum(len(base_spans(r.text)) for r in before) > 0 == sum(len(base_spans(r.text)) for r in after)


def test_mix_repeats_and_leaves_out(kept):
    copies = {tuple(r)[: len(kept[3].columns)]: r.copies for r in mix_sources(kept[3]).collect()}
    assert Counter(as_rows(kept[4])) == Counter({row: n for row, n in copies.items() if n})


def test_tokens_are_those_of_the_library(kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    tokenizer.no_truncation()
    expected = Counter((r.doc_id, r.source, tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in kept[4].collect())
    assert Counter((r.doc_id, r.source, tuple(r.token_ids)) for r in kept[5].collect()) == expected
    assert all(r.n_tokens == len(r.token_ids) for r in kept[5].collect())


def test_run_applies_the_stages_and_reruns_agree(spark, kept):
    found = run(spark, SF)
    assert as_rows(found) == as_rows(kept[5])


def test_odd_tables_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, spans int, score double, copies int"
    rows = [(None, None, None, None, None, "a", 1, 0.5, 2), (1, "", "en", None, 0, None, None, None, None)]
    rows += [(2, "the cat and the dog", "en", "s", 19, "b", 2, 0.1, 3)] * 3 + [(4, "der hund und die katze", "de", "s", 22, "c", 3, 0.2, 9)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, f in STAGES:
            out = f(spark, docs, SF)
            assert name == "bpe" or out.columns == docs.columns
            assert out.count() <= 3 * len(table)

