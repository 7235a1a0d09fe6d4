"""Quality rules against plain Python, and the cleaned texts."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from quadrille.llm import line_rules
from tests.conftest import plan_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
OWN = " ".join(f"own{k}" for k in range(60))


def expected(rows, least=line_rules.LEAST_DOCUMENTS, percent=line_rules.PERCENT_DOCUMENTS, removed=line_rules.PERCENT_REMOVED):
    """Verdicts of ``(doc_id, source, text)``, and the texts without their frequent lines (None: depleted)."""
    lines = [[x for x in (t or "").split("\n") if WORD.search(x)] for _, _, t in rows]
    norm = lambda x: " ".join(WORD.findall(x)).lower()
    hosts = Counter(h for _, h, _ in rows)
    counts = Counter((h, x) for (_, h, _), own in zip(rows, lines) for x in {norm(y) for y in own})
    often = {k for k, n in counts.items() if n > least and 100 * n > percent * hosts[k[0]]}
    out, texts = [], []
    for (doc, host, text), own in zip(rows, lines):
        words = WORD.findall(text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
        gone = sum(len(WORD.findall(x)) for x in own if (host, norm(x)) in often)
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        whole = 100 * gone <= removed * len(words)
        out.append((doc, len(words), sum(map(len, words)), symbols, len(own) - len(set(own)), len(again), failed, not failed and whole, gone))
        if whole:
            texts.append((doc, text if not gone else "\n".join(x for x in text.split("\n") if not WORD.search(x) or (host, norm(x)) not in often)))
    return sorted(out, key=repr), sorted(texts, key=repr)


ROWS = [
    (1, "a", None), (2, "a", ""), (3, "a", " \n\t\x0b "), (4, None, "#5 & <b> 50% | *\n\n# 5"), (4, None, "#5 & <b> 50% | *\n\n# 5"),
    (5, "a", "x " * 80), (6, "a", "a b c d a b c e\n" + OWN), (7, "b", f"{OWN}\r\n{OWN}\r\n{OWN}"), (8, "b", "日本 🙂 ÀÉ\n日本 🙂 ÀÉ\n" + OWN),
    (None, "b", OWN), (None, None, "one two"), (9, "c", " ".join(f"w{k % 9973}" for k in range(40_000))),
    *((100 + k, "hot", f"All  rights\treserved here {OWN}\n{' '.join(f'own{k}x{j}' for j in range(30 + 10 * k))}") for k in range(12)),
    *((200 + k, "hot", f"ALL rights reserved here {OWN.upper()} \nand all of {k}") for k in range(4)),
    *((300 + k, "cold", f"All rights reserved here {OWN}\nx") for k in range(5)),
]
SCHEMA = "doc_id long, source string, text string, row int, lines string, n_words int, _marks int, kept boolean"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, k, "x", 7, 8, False) for k, r in enumerate(ROWS)], SCHEMA).repartition(5)


def test_counts_and_verdicts(docs):
    got = line_rules.quality_rules(docs)
    assert "Python" not in plan_of(got) and "Arrow" not in plan_of(got)
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    want, _ = expected(ROWS)
    assert rows == want
    verdict = {r[0]: (r[6], r[7]) for r in rows}
    assert verdict[100] == (False, False) and verdict[111] == (False, True) and verdict[304] == (False, True) and verdict[5] == (True, False)


def test_cleaned_texts_keep_all_columns(docs):
    got = line_rules.without_frequent_lines(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == expected(ROWS)[1]
    kept = {r.row: (r.lines, r.n_words, r["_marks"], r.kept) for r in got.collect()}
    assert set(kept.values()) == {("x", 7, 8, False)}


def test_limits_are_parameters(docs):
    rows = sorted((tuple(r) for r in line_rules.quality_rules(docs, least_documents=4, percent_documents=99, percent_removed=90).collect()), key=repr)
    assert rows == expected(ROWS, 4, 99, 90)[0]


def test_empty_table(docs):
    assert line_rules.quality_rules(docs.limit(0)).count() == 0
    assert line_rules.without_frequent_lines(docs.limit(0)).count() == 0


def test_equal_hash_bits_do_not_count(spark, monkeypatch):
    # With most bits for the place, nearly all windows look equal at first; the words decide.
    monkeypatch.setattr(line_rules, "_PLACE_BITS", 62)
    rows = [(k, "a", t) for k, t in enumerate([OWN, f"a b c {OWN} a b c", "a a a a a"])]
    got = line_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)[0]
