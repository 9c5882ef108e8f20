"""Every stage of the pipeline against plain Python on its own input, and the registration of the queries."""

import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from conftest import SF
from test_decontamination import brute as passages
from test_ngram_join import brute as groups
from test_packing import check as check_layout
from test_quality_rules import measured

ROOT = Path(__file__).resolve().parents[2]


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def accepted(text):
    n_words, chars, symbols, _, repeated = measured(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    capitals = sum(c.isupper() for c in text or "")
    return not (
        n_words < 50 or 100 * repeated > 50 * n_words or chars < 2 * n_words or chars > 15 * n_words
        or 100 * symbols > 20 * n_words
        or (len(lines) > 1 and 2 * (len(lines) - len(set(lines))) > len(lines))
        or 100 * capitals > 40 * chars
    )


def without_repeats(table, length=100):
    """What is left of each text; characters that are cut in two go."""
    seen, out = set(), {}
    for key, text in sorted((r[0], r[1]) for r in table):
        data = text.encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        parts, at = [], 0
        for m in re.finditer(rb"\x01+", bytes(gone)):
            parts.append(data[at : m.start()])
            at = m.end()
        out[key] = "".join(p.decode(errors="ignore") for p in [*parts, data[at:]])
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """The input of every stage and its output."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        out = pipeline.store(stage(spark, docs, SF), "stage")
        found.append((name, docs, out))
        docs = out
    return found


def test_stages_in_order(stages):
    assert [name for name, _, _ in stages] == [name for name, _ in pipeline.STAGES]
    columns = stages[0][1].columns
    assert all(out.columns == columns for _, _, out in stages[:-1])
    assert all(0 < out.count() <= docs.count() for _, docs, out in stages[:-1])


def test_rules(stages):
    _, docs, out = stages[0]
    assert sorted(rows(out)) == sorted(r for r in rows(docs) if accepted(r[1]))


def test_near_duplicates(stages):
    _, docs, out = stages[1]
    found = groups([(r[0], r[1]) for r in rows(docs)], 5, 80)
    assert sorted(rows(out)) == sorted(r for r in rows(docs) if found[r[0]][1] == r[0])


def test_repeated_passages(stages):
    _, docs, out = stages[2]
    left = without_repeats(rows(docs))
    before = {r[0]: r for r in rows(docs)}
    assert len(left) == out.count()
    for key, text, lang, source, n_chars in rows(out):
        assert text == left[key] and n_chars == len(text) and (lang, source) == before[key][2:4]


def test_benchmark_passages(spark, stages):
    _, docs, out = stages[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # the plain search aligns everything: a part of the documents, and all that went
    kept = {r[0] for r in rows(out)}
    some = [r for r in rows(docs) if r[0] not in kept or r[0] % 10 == 0]
    lost = {key for key, _, _ in passages([(r[0], r[1]) for r in some], items)}
    assert {r[0] for r in some} - kept == lost


def test_packing(stages):
    _, docs, out = stages[4]
    check_layout([(r[0], r[1]) for r in rows(docs)], out.collect(), 2048)


def test_odd_rows(spark, make_documents):
    long = " ".join(f"word{k}" for k in range(300))
    table = make_documents([(None, long + " null"), (1, None), (2, ""), (3, long), (3, long), (4, long + " more"), (5, long[900:1500] + " x y " * 3)])
    docs = table
    for _, stage in pipeline.STAGES[:-1]:
        docs = pipeline.store(stage(spark, docs, SF), "stage")
        assert docs.columns == table.columns
    # of the copies of 3 one row stays; what stands in an earlier text goes from later ones
    assert Counter(r["doc_id"] for r in docs.collect()) == {None: 1, 3: 1, 5: 1}
    packed = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == {None, 3, 5}
    for _, stage in pipeline.STAGES:
        assert stage(spark, make_documents([]), SF).collect() == []


def test_registered_queries():
    names = set(entry.queries())
    assert "pipeline" in names
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert set(entry.oracle_sql()) <= names


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("patronage/**/*.py"), *ROOT.glob("oracles/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert not re.search(r"patronage\.llm|corpus_pipeline|import llm", path.read_text())


def test_entry_without_the_subpackage(tmp_path):
    """A copy of the repository without these folders still imports and has the other queries."""
    for part in ("patronage", "oracles"):
        for path in (ROOT / part).rglob("*.py"):
            if "llm" not in path.parts:
                target = tmp_path / path.relative_to(ROOT)
                target.parent.mkdir(parents=True, exist_ok=True)
                target.write_text(path.read_text())
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import re, __spark_entry__ as e; q = e.queries(); assert 'customer_master' in q and 'pipeline' not in q and not [n for n in q if re.match(r'op[0-9]', n)]; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
