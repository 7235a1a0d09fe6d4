"""The operators against plain Python on small tables: nulls, empty and long texts, ties, repeated rows, empty tables,
and extra columns with names that the operators use themselves."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quadrille.llm import bit_sliced, bpe_count, components, decontaminate, kneser_ney, line_dedup, ngram_join, packing, quality, token_store, url_filter
from quadrille.llm.encode import Encoder
from quadrille.llm.perfect_hash import PerfectHash
from quadrille.llm.words import find_words, text_buffers

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BASE = " ".join(f"word{k}" for k in range(60))
TEXTS = [
    (1, BASE),
    (2, BASE.replace("word30", "other")),
    (3, BASE.upper()),
    (4, None),
    (5, ""),
    (6, "  \n\t "),
    (7, "one two"),
    (8, "One\ntwo"),
    (9, "one two three"),
    (10, "Grüße an das müde Volk,  it's <|endoftext|> don't!\n\nΑΣ ς 日本 🙂 "),
    (10, "Grüße an das müde Volk,  it's <|endoftext|> don't!\n\nΑΣ ς 日本 🙂 "),
    (10, BASE + " " + BASE),
    (None, BASE),
    (None, "nothing else like it in here at all"),
    (11, " ".join(f"long{k % 997}x{k % 31}" for k in range(30000))),
    (12, "a line of six words here\n" * 3 + "end"),
    (-3, "a line of six words here"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, 5, "x", 1.0, True) for d, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, mark string, score double, held_out boolean").repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = tokens(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(rows):
    """Shingle count and smallest reachable id of each row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    out = []
    for (doc, _), own, g in zip(rows, sets, group):
        ids = [d for (d, _), h in zip(rows, group) if h == g and d is not None]
        out.append((doc, len(own), min(ids) if ids else None))
    return sorted(out, key=repr)


def test_near_duplicates(docs, nothing):
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(docs).collect()), key=repr)
    assert got == groups(TEXTS)
    assert ngram_join.near_duplicates(nothing).count() == 0


def test_near_duplicates_of_a_large_group_and_a_hot_passage(spark):
    rows, passage = [], " ".join(f"p{k}" for k in range(40))
    for k in range(60):
        words = BASE.split()
        words[k % 60] = f"edit{k}"
        if k % 2:
            words[(k * 7) % 60] = f"more{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, passage + " " + " ".join(f"own{k}x{i}" for i in range(k))) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in ngram_join.near_duplicates(df).collect()), key=repr) == groups(rows)


def edited(size, edits, seed):
    """Copies of one text, the k-th with ``edits[k]`` words of its own at random places."""
    rng, rows = random.Random(seed), []
    for k, n in enumerate(edits):
        words = [f"w{i}" for i in range(size)]
        for at in rng.sample(range(size), n):
            words[at] = f"new{k}x{at}"
        rows.append((k, " ".join(words)))
    return rows


def test_copies_with_few_partners_do_not_meet_their_whole_group(spark, monkeypatch):
    # Of 150 words, two copies link when they have up to 4 edits together: those with 3 link with the 5 that have one alone.
    edits = [2] * 200 + [1] * 5 + [3] * 60 + [2] * 200
    rows, met, verified = edited(150, edits, 5), [], ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *more: met.append(pairs.count()) or verified(pairs, *more))
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == groups(rows)
    assert sum(met) <= 10 * len(rows)


def test_components(spark):
    edges = [(k, k + 1) for k in range(20)] + [(40, 30), (50, 30), (50, 60), (7, 7)]
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(21)} | {k: 30 for k in (30, 40, 50, 60)}


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    texts = [t for _, t in TEXTS]
    data, offsets = text_buffers(pa.array(texts))
    found = find_words(data, offsets)
    got = [data[a:b].tobytes().decode().translate(LOWER) for a, b in zip(found.start, found.end)]
    assert got == [w for t in texts for w in tokens(t)]
    by_hash = defaultdict(set)
    for h, w in zip(found.hash.tolist(), got):
        by_hash[h].add(w)
    assert len(by_hash) == len(set(got)) and all(len(v) == 1 for v in by_hash.values())


def test_urls(spark):
    urls = [
        (1, "http://Sub.Example.ORG/es/1?x#y"), (2, "https://example.org/en/17"), (3, "ftp://shop.com/fr/"), (4, "http://shop.com/de/a"),
        (5, "http://free-bets.example.net/en/5"), (6, "http://tiontion.example.net/en/7"), (7, None), (8, "no scheme"), (9, "a://b://c/d"),
        (None, "http://x.org"), (11, "http://x.org/"), (12, "http://norg/"), (13, "http://example.org?q=/es/"), (13, "http://example.org/en/2"),
    ]
    df = spark.createDataFrame([(p, u, "h") for p, u in urls], "page_id long, url string, host string")
    rows = [tuple(r)[:5] for r in url_filter.judged(df, url_filter.labelled_urls()).orderBy("page_id").collect()]
    got = {(p, h, q): (rule, v) for p, h, q, rule, v in rows}
    assert got[1, "sub.example.org", "/es/1"] == ("example.org/es/", "block")
    assert got[2, "example.org", "/en/17"] == ("example.org/en/1", "block")
    assert got[3, "shop.com", "/fr/"] == ("com/fr/", "allow")
    assert got[4, "shop.com", "/de/a"] == ("com/de/", "block")
    assert got[5, "free-bets.example.net", "/en/5"] == (None, "block")
    assert got[6, "tiontion.example.net", "/en/7"] == (None, "allow")
    assert got[7, "", ""][0] is None and got[8, "", ""][0] is None
    assert (9, "b:", "//c/d") in got
    assert got[None, "x.org", ""][0] is None and got[11, "x.org", "/"] == ("org/", "allow")
    assert got[12, "norg", "/"][0] is None and got[13, "example.org", ""][0] is None and got[13, "example.org", "/en/2"] == ("org/", "allow")
    assert url_filter.judged(df.limit(0), []).count() == 0


def test_url_classifier_holds_out(spark):
    """Host words that were left out of the fit are still told apart by their pieces."""
    rows = url_filter.labelled_urls()
    parts = [(re.match(r"[^/?#]*", u.split("://")[1])[0], label) for u, label in rows]
    fit, test = [p for k, p in enumerate(parts) if k % 4], parts[::4]
    weights, bias = url_filter.train([h for h, _ in fit], [""] * len(fit), [y for _, y in fit])
    import pyarrow as pa

    found = url_filter.scores(pa.array([h for h, _ in test]), pa.array([""] * len(test)), weights, bias) >= 0.5
    assert np.mean(found == np.array([y for _, y in test], bool)) > 0.85


def test_line_dedup(docs, nothing):
    rows = line_dedup.without_repeats(docs).select("doc_id", "text", "spans", "mark", "n_tokens").collect()
    assert len(rows) == len(TEXTS) and all(r.n_tokens == 5 for r in rows)
    kept = defaultdict(list)
    for r in rows:
        kept[r.doc_id].append(r)
    (first,), (later,) = kept[-3], kept[12]
    assert first.text == "a line of six words here" and first.spans is None
    assert later.text == "end" and [tuple(s) for s in later.spans] == [(0, 24), (25, 49), (50, 74)]
    assert kept[1][0].text == BASE and kept[3][0].text == "" and kept[4][0].text is None and kept[7][0].text == "one two"
    assert {r.text for r in kept[None]} == {"", "nothing else like it in here at all"}
    assert line_dedup.without_repeats(nothing).count() == 0


def test_line_dedup_units(spark):
    text = "first par with five words\nand more of it\n\nsecond par also with words\n\nfirst par with five words\nand more of it"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = line_dedup.without_repeats(df, unit="paragraph").first()
    assert [tuple(s) for s in got.spans] == [(70, 110)] and got.text == text[:69]
    assert line_dedup.without_repeats(df, least_words=99).first().text == text


def without_passages(rows, least=5, run=25):
    """Plain Python: a flag per character of what stands earlier, as a line or sentence or as one of 51 words, then runs of flags."""
    fold = lambda s: " ".join(s.translate(LOWER).split())
    units = []
    for doc, text in sorted(rows):
        at = 0
        for line in text.split("\n"):
            found, pieces, place = [(at, at + len(line))], re.split(r"(?<=[.!?])(?=\s)", line), at
            for k, piece in enumerate(pieces):
                place += len(piece)
                if len(piece.split()) >= least:
                    end, more = place, k + 1
                    found.append((place - len(piece), end))
                    while more < len(pieces) and len(pieces[more].split()) < least:
                        end, more = end + len(pieces[more]), more + 1
                    found.append((place - len(piece), end))
            units += [(doc, a, b, fold(text[a:b])) for a, b in found if len(text[a:b].split()) >= least]
            at += len(line) + 1
    first = {}
    for doc, a, b, words in units:
        first[words] = min(first.get(words, (doc, a)), (doc, a))
    texts, flags = dict(rows), {d: bytearray(len(t)) for d, t in rows}
    for doc, a, b, words in units:
        if first[words] != (doc, a):
            flags[doc][a:b] = b"\1" * (b - a)
    out, inside = {}, left_over(rows)
    for doc, text in texts.items():
        flag = bytearray(a | b for a, b in zip(flags[doc], inside[doc]))
        for gap in re.finditer(r"\s+", text):
            if gap.start() and gap.end() < len(text) and flag[gap.start() - 1] and flag[gap.end()]:
                flag[gap.start() : gap.end()] = b"\1" * len(gap[0])
        spans = []
        for match in re.finditer(b"\1+", bytes(flag)):
            a, b = match.span()
            if len(text[a:b].split()) >= run:
                while a and text[a - 1] in " \t":
                    a -= 1
                spans.append((a, b))
        keep = bytearray(b"\1" * len(text))
        for a, b in spans:
            whole = a == 0 or text[a - 1] == "\n"
            keep[a : b + 1 if whole and b < len(text) and text[b] == "\n" else b] = b"\0" * (min(len(text), b + 1 if whole and b < len(text) and text[b] == "\n" else b) - a)
        kept = "".join(c for c, k in zip(text, keep) if k)
        out[doc] = kept[:-1] if kept.endswith("\n") and not text.endswith("\n") else kept
    return out


def test_passages_inside_lines(spark, docs, nothing):
    passage = " ".join(f"Sentence {k} of the shared part has several words." for k in range(6)) + " Yes. End."
    texts = {
        1: f"Own words open the first of these texts. {passage} And own words close it as well.",
        2: f"Quite another start it has here, this one. {passage}\nA line of its own after that.",
        3: f"{passage}\n{passage.upper()}",
        4: "Sentence 2 of the shared part has several words. But it is quoted alone, so it stays.",
        5: "A line of its own after that.\n\nNo. No. No. No.",
        6: "",
    }
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in line_dedup.without_repeats(table, unit="passage").collect()}
    assert {d: r.text for d, r in got.items()} == without_passages(list(texts.items()))
    assert got[1].text == texts[1] and got[4].text == texts[4] and got[1].spans is None and got[4].spans is None
    assert got[2].text == "Quite another start it has here, this one.\nA line of its own after that."
    assert [tuple(s) for s in got[2].spans] == [(42, 43 + len(passage))] and got[3].text == "" and got[5].text == texts[5]
    assert line_dedup.without_repeats(docs, unit="passage").count() == docs.count()
    assert line_dedup.without_repeats(nothing, unit="passage").count() == 0


def left_over(rows, least=51):
    """Plain Python: for each text the character flags of runs of ``least`` words that stand earlier."""
    seen, out = {}, {}
    for doc, text in sorted(rows):
        words = [(m.start(), m.end(), m[0].translate(LOWER)) for m in re.finditer(r"[^ \t\n\r\v\f]+", text)]
        out[doc] = bytearray(len(text))
        for k in range(len(words) - least + 1):
            own, (a, b) = tuple(w for _, _, w in words[k : k + least]), (words[k][0], words[k + least - 1][1])
            where = seen.setdefault(own, (doc, b))
            if where[0] != doc or a >= where[1]:
                out[doc][a:b] = b"\1" * (b - a)
    return out


def test_passages_with_edges_inside_sentences(spark):
    draw = np.random.default_rng(3)
    word = lambda n, tag: " ".join(f"{tag}{x}" for x in draw.integers(0, 10**9, n))
    passage, long = word(55, "pé"), ". ".join(word(9, "s") for _ in range(8))
    texts = {
        1: f"{word(20, 'a')} {passage} {word(9, 'a')}. {long} {word(5, 'a')}.",
        2: f"{word(30, 'b')} {passage.replace('p', 'P')} {word(7, 'b')}",  # no sentence marks
        3: f"{word(3, 'ü')} {long[5:]} {word(4, 'c')}. {word(6, 'c')}.",  # from the middle of a sentence on
        4: f"{word(8, 'd')} {' '.join(passage.split()[:50])} {word(8, 'd')}",  # too short
        5: f"{word(4, 'e')}\n{passage.replace(' ', chr(10), 20)} {word(4, 'e')}",
        6: " ".join(["again"] * 200),
    }
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in line_dedup.without_repeats(table, unit="passage").collect()}
    flags = left_over(list(texts.items()))
    for doc, text in texts.items():
        kept = "".join(c for c, gone in zip(text, flags[doc]) if not gone)
        assert got[doc].split() == kept.split(), doc
    assert [any(flags[d]) for d in texts] == [False, True, True, False, True, True] and got[1] == texts[1] and got[4] == texts[4]
    assert len(got[2].split()) == 37 and "  " not in got[2] and len(got[6].split()) == 51


def contaminated(rows, items, width=13):
    cut = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER).encode())
    windows = defaultdict(set)
    for i, t in items:
        w = cut(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[k : k + width])].add(i)
    out = []
    for d, t in rows:
        w, hit, found = cut(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[tuple(w[k : k + size])]
        names = ",".join(sorted("" if i is None else str(i) for i in found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [None, 60])
def test_decontamination(spark, docs, nothing, monkeypatch, block):
    items = [(1, " ".join(f"word{k}" for k in range(10, 40))), (2, "one, TWO"), (2, "long5x5"), (3, None), (4, "..."), (None, "Volk it"), (7, BASE)]
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    if block:
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    got = sorted((tuple(r) for r in decontaminate.contamination(docs, table).collect()), key=repr)
    assert got == contaminated(TEXTS, items)
    assert decontaminate.contamination(nothing, table).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, table.limit(0)).collect())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


ODD = [
    "a  b   c\n\n  d\t e", " ", "\n", " x <|endoftext|> y\n", "\u3000a b\u2003 ", "it's  don't\r\n ok", "x \x1c y", "tail  \n", "x's. 'LL",
    "१२ 3a a3 a.3", "a\n b", "İstanbul é é ﬁ ａｂ", "<|startoftext|>a<|ENDOFTEXT|>", "12 3a --!!", "ΑΣ Σ ς", "\x00 \x7f",
]


def test_encoder_is_the_library(library):
    encode = Encoder(BYTES)
    for text in [t or "" for _, t in TEXTS] + ODD:
        want = np.array(library[0].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode.encode(text) == want, text[:80]


def test_token_counts(docs, nothing, library):
    got = sorted((tuple(r) for r in bpe_count.token_counts(docs, WORDS, limit=100).collect()), key=repr)
    want = []
    for d, t in TEXTS:
        n = len(library[1].encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 100))
    assert got == sorted(want, key=repr)
    counter = bpe_count.Counter(WORDS)
    assert [counter.count(t) for t in ODD] == [len(library[1].encode(t, add_special_tokens=False).ids) for t in ODD]
    assert bpe_count.token_counts(nothing, WORDS).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 20000)
    keys = np.unique(np.concatenate((keys, [0, 1, -1])))
    found = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes()).find(keys)
    assert sorted(found.tolist()) == list(range(len(keys)))


def test_token_store(spark, docs, nothing, library, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_BYTES", 50_000)
    manifest = token_store.write_store(docs, BYTES, end_id=2)
    ids = {t: np.array([*library[0].encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in TEXTS}
    rows = token_store.read_store(manifest, with_ids=True).collect()
    assert sorted(((r.doc_id, tuple(r.ids)) for r in rows), key=repr) == sorted(((d, tuple(ids[t].tolist())) for d, t in TEXTS), key=repr)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((d for d, _ in TEXTS), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in rows] == np.concatenate(([0], np.cumsum([r.n_tokens for r in rows])[:-1])).tolist()
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.n_tokens == len(r.ids) for r in rows)
    wanted = spark.createDataFrame([(10,), (1,), (999,), (None,), (10,), (-3,)], "doc_id long")
    got = sorted((r.doc_id, tuple(r.ids)) for r in token_store.fetch(manifest, wanted).collect())
    assert got == sorted((d, tuple(ids[t].tolist())) for d, t in TEXTS if d in (10, 1, -3))
    assert token_store.read_store(token_store.write_store(nothing, BYTES, end_id=2)).count() == 0
    entry = manifest.where("low is not null").first()
    store, path = token_store.file_system(entry.folder)
    shard = token_store.Shard(store, f"{path}/{entry.file}")
    slot_of = lambda keys: shard.slots[np.clip(shard.hash.find(keys), 0, len(shard.slots) - 1), 0]
    monkeypatch.setattr(token_store, "fingerprints", slot_of)
    assert shard.find(np.array([entry.low]))[1][0] > 0
    assert not shard.find(np.arange(10**9, 10**9 + 200))[1].any()


def test_packing(docs, nothing, library):
    rows = packing.packed(docs, BYTES, capacity=512).collect()
    sequences, pieces = defaultdict(list), defaultdict(int)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.ids_crc32, r.length, r.doc_id, r.piece, r.start] += 1
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    want = defaultdict(int)
    for d, t in TEXTS:
        x = np.array([*library[0].encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        start, stop, k = 0, len(x) if len(x) <= 512 else len(x) % 512 or 512, 0
        while start < len(x):
            want[zlib.crc32(x[start:stop].tobytes()), stop - start, d, k, start] += 1
            start, stop, k = stop, stop + 512, k + 1
    assert pieces == want
    assert packing.packed(nothing, BYTES).count() == 0


def fewest(lengths, capacity):
    """Fewest sequences by trying everything."""
    best = [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for n in range(len(rooms)):
            if rooms[n] >= lengths[k]:
                place(k + 1, rooms[:n] + [rooms[n] - lengths[k]] + rooms[n + 1 :])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(25))
def test_bin_completion_is_optimal_on_small_cases(seed):
    draw = np.random.default_rng(seed)
    lengths = sorted(draw.integers(1, 21, 9).tolist(), reverse=True)
    patterns = packing.bin_completion(np.bincount(lengths, minlength=21), 20)
    packed = sorted((x for p in patterns for x in p.lengths * p.copies), reverse=True)
    assert packed == lengths and all(sum(p.lengths) <= 20 for p in patterns)
    assert sum(p.copies for p in patterns) == fewest(lengths, 20)
    assert packing.lower_bound(np.bincount(lengths, minlength=21), 20) <= fewest(lengths, 20)


def test_bin_completion_beats_best_fit():
    counts = np.bincount([6, 5, 5, 4, 4, 3, 3] * 1, minlength=11)  # 6+4, 5+5, 4+3+3
    assert sum(p.copies for p in packing.bin_completion(counts, 10)) == 3


@pytest.mark.parametrize("times", [1, 7, 1000])
def test_bin_completion_branches_on_copies(times):
    counts = np.bincount([35, 35, 32, 32, 15, 15, 14, 14, 14, 11, 11], minlength=61) * times
    patterns = packing.bin_completion(counts, 60)
    assert sum(p.copies for p in patterns) == 4 * times and all(sum(p.lengths) <= 60 for p in patterns)
    assert (sum(p.copies * np.bincount(p.lengths, minlength=61) for p in patterns) == counts).all()


def test_every_filling():
    counts = np.bincount([7, 5, 5, 3, 3, 3, 2], minlength=13)
    found = [f for f in packing._every_filling(counts, 12) if f]
    every = {c for n in range(1, 8) for c in itertools.combinations([7, 5, 5, 3, 3, 3, 2], n) if sum(c) <= 12}
    whole = {c for c in every if not any(counts[x] > c.count(x) and sum(c) + x <= 12 for x in (7, 5, 3, 2))}
    assert len(found) == len(set(found)) and set(found) == whole


def test_top_k(spark):
    draw = np.random.default_rng(5)
    rows = [(k, (draw.standard_normal(8) * (0.05 if k % 3 else 2)).astype(np.float32).tolist(), 1) for k in range(300)]
    rows += [(k, rows[20][1], 1) for k in range(300, 360)]
    bad = [(1000, None, 1), (1020, [1.0, None], 1), (1040, [float("nan")] * 8, 1), (1060, [float("inf")] * 8, 1), (None, [1.0] * 8, 1)]
    df = spark.createDataFrame(rows + bad + [rows[7]], "vec_id long, embedding array<float>, score int").repartition(3)
    whole = {k: np.floor(64 * np.array(v, np.float64)).astype(np.int64) for k, v, _ in rows}
    want = []
    for q in (k for k in whole if k % 20 == 0):
        order = sorted((-int(whole[q] @ v), k) for k, v in whole.items() if k != q)[:5]
        want += [(q, n + 1, k, -s) for n, (s, k) in enumerate(order)]
    assert sorted(map(tuple, bit_sliced.top_k(df, k=5).collect())) == sorted(want)
    assert bit_sliced.top_k(df.limit(0)).count() == 0
    few = spark.createDataFrame([(20, [0.5]), (21, [0.25, -1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in bit_sliced.top_k(few).collect()] == [(20, 1, 21, 32 * 16)]


def test_top_k_of_repeated_ids(spark):
    draw = np.random.default_rng(8)
    rows = [(k % 90, draw.standard_normal(6).astype(np.float32).tolist()) for k in range(200)] + [(20, [3.0] * 6)] * 9
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    whole = [(k, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for k, v in rows]
    want = []
    for q in {k for k, _ in whole if k % 20 == 0}:
        order = sorted((-int(x @ v), k) for i, x in whole if i == q for k, v in whole if k != q)[:5]
        want += [(q, n + 1, k, -s) for n, (s, k) in enumerate(order)]
    assert sorted(map(tuple, bit_sliced.top_k(df, k=5).collect())) == sorted(want)


def test_language_model(docs, nothing):
    import math
    from collections import Counter

    rows = [(d, tokens(t) + [None], zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1) for d, t in TEXTS]
    count, pair = Counter(), Counter()
    for _, w, held in rows:
        if not held:
            count.update(w)
            pair.update(zip(["", *w], w))
    total, left, before = Counter(), Counter(), Counter()
    d = kneser_ney.discounts(np.array([sum(c == k for c in pair.values()) for k in (1, 2, 3, 4)]))
    for (v, w), c in pair.items():
        total[v] += c
        left[v] += d[min(c, 3)]
        before[w] += 1
    e = kneser_ney.discounts(np.array([sum(c == k for c in before.values()) for k in (1, 2, 3, 4)]))
    spare = sum(e[min(c, 3)] for c in before.values()) / len(pair)
    n, size = sum(count.values()), len(count)

    def p(v, w):
        low = max(before[w] - e[min(before[w], 3)], 0) / len(pair) + spare / (size + 1)
        return low if not total[v] else max(pair[v, w] - d[min(pair[v, w], 3)], 0) / total[v] + left[v] / total[v] * low

    assert sum(p("word1", w) for w in count) + p("word1", "never") == pytest.approx(1)
    want = sorted(
        (repr(i), held, len(w), sum(x in count for x in w), n, round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (size + 1))) for x in w), 5),
         round(sum(math.log10(p(v, x)) for v, x in zip(["", *w], w)), 5))
        for i, w, held in rows
    )
    got = kneser_ney.language_scores(docs).collect()
    found = sorted((repr(r.doc_id), *tuple(r)[1:5], round(r.base_score, 5), round(r.score, 5)) for r in got)
    for a, b in zip(found, want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6)
    assert kneser_ney.language_scores(nothing).count() == 0


def test_language_model_without_training_rows(docs):
    held = docs.where("doc_id = 1").withColumn("doc_id", F.lit(next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)))
    row = kneser_ney.language_scores(held).first()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0 and row.score <= 0


def test_quality(spark, docs, nothing):
    noisy = [(100 + k, f"BUY NOW!!! {k} $$$ ### !!!" * (3 + k % 5)) for k in range(80)]
    clean = [(200 + k, f"the quiet river runs past house number {k} and on to the sea. " * (3 + k % 5)) for k in range(80)]
    rows = spark.createDataFrame(noisy + clean, "doc_id long, text string").unionByName(docs.select("doc_id", "text")).withColumn("quality", F.lit(9))
    marks = [(d, 0, 1) for d, _ in noisy] + [(d, 1, 1) for d, _ in clean] + [(None, 1, 1), (201, None, 1), (202, 5, 1), (99999, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, text int")
    got = quality.quality_scores(rows, labels).collect()
    assert len(got) == len(TEXTS) + 160 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 100]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id >= 200) for r in held]) > 0.95
    # Held-out labels are never read.
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {(r.doc_id, r.score) for r in quality.quality_scores(rows, flipped).collect()}
    assert again == {(r.doc_id, r.score) for r in got}
    assert quality.quality_scores(nothing, labels).count() == 0
    assert quality.quality_scores(docs, labels.limit(0)).count() == len(TEXTS)
    kept = quality.with_quality(docs.withColumn("_score", F.lit(1)), quality.Model(), "score")
    assert set(kept.columns) == {*docs.columns, "_score"} and {r["_score"] for r in kept.collect()} == {1}
