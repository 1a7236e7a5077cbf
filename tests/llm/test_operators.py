"""The corpus operators against brute force, and on odd input."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

import corpus_pipeline
from textprep.llm import (
    exact_dedup, groups, jaccard_join, language_id, licenses, mixing, overlap, packing,
    quality_classifier, quality_rules, suffix_dedup, suffix_sort, toxicity,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, kept string, target int"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", None, "a", 3), (4, "one two three", "en", None, 13),
    (5, "One  two\nthree", "en", "b", 14), (5, "One  two\nthree", "en", "b", 14), (None, "one two three", "en", "b", 13),
    (6, LONG, "en", "b", len(LONG)), (7, LONG, "de", "c", len(LONG)), (8, "123 456", "de", "c", 7),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def rows_by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_exact_duplicates(docs, odd, empty):
    want = collections.defaultdict(list)
    for i, t in texts(docs).items():
        want[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    got = rows_by_id(exact_dedup.exact_duplicates(docs))
    for t, ids in want.items():
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (min(ids), len(ids), i == min(ids))
            assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    found = exact_dedup.exact_duplicates(odd).collect()
    assert len(found) == len(ODD)
    assert sum(r["kept"] for r in found if r["doc_id"] == 5) == 1
    assert exact_dedup.keep_first(odd).count() == sum(r["kept"] for r in found)
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_quality_rules(docs, odd, empty):
    got = rows_by_id(quality_rules.judge(docs))
    for i, t in texts(docs).items():
        w = WORD.findall(t)
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        count, covered, seen, repeated = collections.Counter(windows), set(), set(), 0
        for k, x in enumerate(windows):
            if count[x] > 1:
                covered |= {k, k + 1, k + 2}
        for line in t.split("\n"):
            if WORD.search(line):
                repeated += line in seen
                seen.add(line)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(covered), repeated)
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
    assert quality_rules.judge(odd).count() == len(ODD) and quality_rules.judge(empty).count() == 0
    assert quality_rules.keep_good(odd).columns == odd.columns


def brute_components(documents, size, percent):
    sets, parent = {}, {i: i for i in documents}
    for i, t in documents.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_jaccard_components(docs, size, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs, size=size, percent=percent).collect()}
    assert got == brute_components(texts(docs), size, percent)


def test_jaccard_large_groups_and_odd_input(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(groups, "CELL_MEMBERS", 4)
    monkeypatch.setattr(overlap, "BLOCK_SHINGLES", 300)
    rng = np.random.default_rng(1)
    base = [f"v{i}" for i in range(90)]
    many = {}
    for i in range(60):
        own = list(base)
        for k in rng.integers(0, 90, int(rng.integers(0, 3))):
            own[k] = f"u{i}_{k}"
        many[i] = " ".join(own)
    frame = spark.createDataFrame(list(many.items()), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(frame).collect()}
    assert got == brute_components(many, 4, 85)
    assert jaccard_join.jaccard_components(odd).count() == len(ODD)
    assert jaccard_join.jaccard_components(empty).count() == 0


@pytest.mark.parametrize("crowd", [1000, 2])
def test_suffix_dedup(docs, odd, empty, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    data = {i: t.encode() for i, t in texts(docs).items()}
    count = collections.Counter(b[p : p + 200] for b in data.values() for p in range(len(b) - 199))
    got = rows_by_id(suffix_dedup.repeated_spans(docs))
    for i, b in data.items():
        covered = bytearray(len(b))
        for p in range(len(b) - 199):
            if count[b[p : p + 200]] > 1:
                covered[p : p + 200] = b"\1" * 200
        r = got[i]
        kept = bytes(x for x, c in zip(b, covered) if not c)
        runs = sum(1 for k, c in enumerate(covered) if c and not (k and covered[k - 1]))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(b), sum(covered), runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    found = rows_by_id(suffix_dedup.repeated_spans(odd))
    assert found[6]["n_removed"] == found[7]["n_removed"] == len(LONG) and found[1]["n_bytes"] == 0
    assert suffix_dedup.repeated_spans(empty).count() == 0


@pytest.mark.parametrize("held", [1_000_000, 20_000])
def test_suffix_dedup_hot_passage(spark, docs, held, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HELD_STRINGS", held)
    rng = np.random.default_rng(3)
    passage = rng.integers(97, 123, 300, np.uint8).tobytes()
    texts_ = [rng.integers(97, 123, 400, np.uint8).tobytes() + passage + rng.integers(97, 123, 400, np.uint8).tobytes() for _ in range(300)]
    places = [suffix_dedup.anchors(np.frombuffer(t, np.uint8), 200, 50)[0] for t in texts_]
    spots = [[{"at": int(p), "crowded": True} for p in at if 350 < p < 700] for at in places]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "mark": [0] * 300, "text": [t.decode() for t in texts_], "spots": spots})
    def in_cells(hot):
        rows = pa.Table.from_batches(suffix_dedup._context_rows(200, 50, hot)([batch])).to_pylist()
        return rows, collections.Counter(r["cell"] for r in rows if r["kind"] == 0)

    crowds = in_cells(frozenset())[1]
    rows, cells = in_cells(frozenset(c for c, n in crowds.items() if n > 50))
    # No large group of contexts to sort, and a string is sent once for all its places.
    assert max(crowds.values()) > 250 and max(cells.values(), default=0) <= 50
    sent = collections.Counter((r["cell"], r["context"]) for r in rows if r["kind"] == 2)
    assert max(sent.values()) <= sum(map(len, spots)) * 151 // held + 1
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    got = rows_by_id(suffix_dedup.repeated_spans(spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts_)], "doc_id bigint, text string").repartition(4)))
    count = collections.Counter(t[p : p + 200] for t in texts_ for p in range(len(t) - 199))
    for i, text in enumerate(texts_):
        starts = [p for p in range(len(text) - 199) if count[text[p : p + 200]] > 1]
        assert got[i]["spans"] == [[starts[0], starts[-1] + 200]] and len(starts) == starts[-1] - starts[0] + 1
    want = rows_by_id(suffix_dedup.repeated_spans(docs))
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    assert rows_by_id(suffix_dedup.repeated_spans(docs)) == want


@given(st.lists(st.tuples(st.integers(0, 3), st.binary(max_size=40).map(lambda b: bytes(x % 3 for x in b))), min_size=1, max_size=40))
def test_deep_shallow_sort(rows):
    groups, strings = np.array([g for g, _ in rows]), [s for _, s in rows]
    order, common = suffix_sort.sort_strings(groups, strings)
    assert sorted(order.tolist()) == list(range(len(rows)))
    for k in range(1, len(rows)):
        a, b = order[k - 1], order[k]
        if groups[a] != groups[b]:
            assert common[k] == -1
        else:
            assert common[k] == suffix_sort.common_prefix(strings[a], strings[b])


def test_shallow_order_goes_deeper_only_into_equal_runs(monkeypatch):
    seen, lexsort = [], np.lexsort
    monkeypatch.setattr(suffix_sort.np, "lexsort", lambda keys: seen.append((len(keys), len(keys[0]))) or lexsort(keys))
    texts_ = [b"a" * 8 + b"2", b"b" * 20, b"a" * 8 + b"1", b"c" * 20, b"d" * 9, b"a" * 3]
    order, common = suffix_sort.sort_strings(np.array([0, 0, 0, 0, 0, 1]), texts_)
    assert order.tolist() == [2, 0, 1, 3, 4, 5] and common.tolist() == [-1, 8, 0, 0, 0, -1]
    # One word at a time: five rows of the first group, then the two that agree in it.
    assert seen == [(2, 5), (2, 2)]


@pytest.mark.parametrize("few", [100_000, -1])
def test_mixing(docs, odd, empty, few):
    got = mixing.mix(docs, broadcast_sources=few).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    totals, size, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        s = source[r["doc_id"]]
        totals[s] += r["taken"]
        size[s] += r["size"]
        target[s] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * sum(size.values())
    assert all(target[s] <= 2 * size[s] + 1e-9 for s in size)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: s.encode()))}
    levels = [target[s] / weight[s] for s in size if target[s] < 2 * size[s] - 1e-9]
    assert max(levels) - min(levels) < 1e-6 * max(levels)
    assert sorted(got) == sorted(mixing.mix(docs.repartition(3), broadcast_sources=few).collect())
    copies = sum(r["copies"] for r in mixing.mix(odd, broadcast_sources=few).collect())
    assert mixing.mixed_documents(odd, broadcast_sources=few).count() == copies
    assert mixing.mix(empty, broadcast_sources=few).count() == 0


def check_packed(rows):
    places = collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places)


def test_packing(docs, odd, empty):
    rows = packing.pack(docs).collect()
    tokens = sum(r["length"] for r in rows)
    assert check_packed(rows) <= 1.02 * -(-tokens // 1024)
    encode, want = packing.Ids().slow.encode, []
    for i, t in texts(docs).items():
        ids = np.array([*encode(t, add_special_tokens=False).ids, 2], "<u4")
        start = piece = 0
        while start < len(ids):
            stop = start + (len(ids) % 1024 or 1024 if start == 0 else 1024)
            want.append((i, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
            start, piece = stop, piece + 1
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    found = packing.pack(odd).collect()
    check_packed(found)
    assert len({r["doc_id"] for r in found}) == 9 and packing.pack(empty).count() == 0


def test_both_tokenizers_agree():
    ids = packing.Ids()
    sample = ["".join(f"a{chr(c)}{chr(c)} {chr(c)}1 " for c in range(a, a + 32)) for a in range(0, 0x250, 32)]
    for text in [*sample, "<|endoftext|> x", " \n\n  y", "don't I'LL"]:
        assert ids.fast.encode(text, allowed_special="all") == ids.slow.encode(text, add_special_tokens=False).ids
    for text in ("\n" * 1_000_000, "a" + " " * 1_000_000 + "b", "x" * 300_000):
        assert ids(text).tolist() == ids.slow.encode(text, add_special_tokens=False).ids


def test_classifiers_on_held_out_rows(spark, docs, odd, empty):
    sf = SF.replace("0.001", "0.1")
    large, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    for score, label, least in ((toxicity.score_toxicity, "toxic", 0.9), (quality_classifier.score_quality, "quality", 0.9)):
        found = score(large, labels).join(labels, "doc_id").filter("held_out").select(label, "predicted").collect()
        assert np.mean([r[0] == r[1] for r in found]) > least
        if label == "toxic":
            assert np.mean([r[1] for r in found if r[0]]) > 0.7 and np.mean([r[1] for r in found if not r[0]]) < 0.02
        assert score(odd, labels).filter("score between 0 and 1").count() == len(ODD)
        assert score(empty, labels).count() == 0 and score(odd, labels.limit(0)).count() == len(ODD)


def test_language_id(docs, odd, empty, spark):
    large = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    found = language_id.identify_languages(large).join(large.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95
    unknown = rows_by_id(language_id.identify_languages(odd))
    assert all(unknown[i]["lang_pred"] == "und" for i in (1, 2, 3, 8))
    assert language_id.identify_languages(empty).count() == 0


def test_licenses(spark, odd, empty):
    rows = [(1, "text\nReleased under the MIT License.\nmore"), (2, "nothing here at all"), (3, "licensed under CC BY-NC 4.0"), (4, None)]
    got = rows_by_id(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert [got[i]["license"] for i in (1, 2, 3, 4)] == ["MIT", None, "CC-BY-NC-4.0", None]
    assert licenses.scan_licenses(odd).count() == len(ODD) and licenses.scan_licenses(empty).count() == 0


def brute_windows(text, min_dice):
    """The best coefficient of any window of a text, over all windows and templates."""
    words, best = re.findall(r"[a-z0-9]+", text.lower()), 0.0
    pairs = list(zip(words, words[1:]))
    for _, body in licenses.TEMPLATES:
        want = {tuple(g.split()) for g in licenses.template_bigrams(body)}
        most = int(len(want) * (2 - min_dice) / min_dice + 1e-9)
        for a in range(len(pairs)):
            for b in range(a + 1, min(len(pairs), a + most) + 1):
                own = set(pairs[a:b])
                best = max(best, 2 * len(own & want) / (len(own) + len(want)))
    return best if best >= min_dice else 0.0


def test_licenses_among_other_words(spark):
    mit, gpl = licenses._MIT, licenses._GPL.format(3)
    wrapped = "\n".join(re.findall(r".{1,60}(?: |$)", mit))
    header = "/*\n * acme.c of acme\n *\n" + "".join(f" * {x}\n" for x in re.findall(r".{1,50}(?: |$)", licenses._APACHE)) + " *\n * other words of the header here\n */\nint x;"
    want = {
        1: ("This project is licensed under the MIT License.", "MIT", "licensed under the MIT License"),
        2: ("The code in this repository is released under the MIT License.", "MIT", "released under the MIT License"),
        3: ("Licensed under the MIT License. See LICENSE for details.", "MIT", "Licensed under the MIT License"),
        4: ("We think that it is fine. It is licensed under CC BY-SA 4.0, and nothing else is to be said.", "CC-BY-SA-4.0", "licensed under CC BY-SA 4.0"),
        5: (f"Many words come first in this long paragraph.\nAnd then {wrapped}\nand more words\nof the same paragraph follow " + LONG[:900], "MIT", None),
        6: (header, "Apache-2.0", None),
        7: ("\n".join(f"# {x}" for x in re.findall(r".{1,40}(?: |$)", LONG[:600] + gpl + " " + LONG[:600])), "GPL-3.0", None),
        8: ("Licensed under the", None, None),
        9: ("It was released under the bridge, with mit and license apart.", None, None),
    }
    got = rows_by_id(licenses.scan_licenses(spark.createDataFrame([(i, t) for i, (t, _, _) in want.items()], "doc_id bigint, text string")))
    for i, (text, name, statement) in want.items():
        assert got[i]["license"] == name, i
        assert abs(got[i]["dice"] - brute_windows(text, licenses.MIN_DICE)) < 1e-9
        if statement:
            assert (got[i]["statement"], got[i]["n_statements"]) == (statement, 1)
    two = "This is Released under the MIT License. The rest is licensed under CC BY-NC 4.0 today.\nReleased under the MIT License."
    row = licenses.scan_licenses(spark.createDataFrame([(1, two)], "doc_id bigint, text string")).first()
    assert (row["n_statements"], row["licenses"], row["statement"]) == (2, "CC-BY-NC-4.0,MIT", "Released under the MIT License.")


def test_pipeline(spark, docs):
    kept, columns = docs, docs.columns
    for name, function in corpus_pipeline.STAGES[:3]:
        kept = function(spark, kept, SF)
        assert kept.columns == columns
    good = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    first = {}
    for i, t in sorted(texts(docs).items()):
        if i in good:
            first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    left = brute_components(dict(first.values()), 5, 80)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in left.items() if i == c}
    check_packed(corpus_pipeline.run(spark, SF).collect())


@pytest.mark.parametrize("salts", [1, 32, 100])
def test_exact_duplicates_move_texts_once(spark, odd, salts):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    found = exact_dedup.exact_duplicates(odd, salts=salts)
    exchanges = [line for line in plan(found).splitlines() if "Exchange hashpartitioning" in line]
    assert sum("content" in line for line in exchanges) == 1
    want = exact_dedup.exact_duplicates(odd).collect()
    assert sorted(map(str, found.collect())) == sorted(map(str, want))


def test_suffix_contexts_leave_before_the_batch_ends():
    import tracemalloc

    rng = np.random.default_rng(4)
    n, spots = 1_500, [{"at": at, "crowded": False} for at in range(200, 1_400, 20)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array(range(n)), pa.array([rng.bytes(1_600) for _ in range(n)], pa.binary()), pa.array([spots] * n)],
        names=["doc_id", "mark", "text", "spots"],
    )
    tracemalloc.start()
    rows = sum(b.num_rows for b in suffix_dedup._context_rows(200, 50)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n * len(spots) and peak < 60 << 20, peak


def test_suffix_dedup_holds_one_worker_per_task(docs):
    plan = suffix_dedup.repeated_spans(docs)._jdf.queryExecution().executedPlan().toString()
    above = {}  # per depth whether a Python step is above, in the same stage
    steps = 0
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        name = line.lstrip(" :+-").split(" ", 1)[-1] if line.lstrip(" :+-").startswith("*") else line.lstrip(" :+-")
        inherited = any(on for d, on in above.items() if d < depth and d == max(x for x in above if x < depth))
        above = {d: on for d, on in above.items() if d < depth}
        python = name.startswith("MapInArrow")
        assert not (python and inherited), plan
        above[depth] = python or (inherited and not name.startswith("Exchange"))
        steps += python
    assert steps >= 3
