import random

import numpy as np
from pyspark.sql import functions as F

from fiscalis.llm import common, lines
from fiscalis.llm.common import bucket_edges, connected_components
from fiscalis.llm.lines import LineParams, band_keys, dedup_lines, jaccard_forest, line_forest, normal_lines, op4_line_dedup, shingle_set


def similar(a, b):
    common = len(a & b)
    return common >= 0.8 * (len(a) + len(b) - common)


def plain(docs):
    """Kept texts by the definition, over all pairs of lines."""
    place = {}
    for i, t in docs:
        for n, line in enumerate(normal_lines(t or "")):
            if line:
                place[line] = min(place.get(line, (1 << 62, 0)), (i, n))
    lines = list(place)
    sets = [{x[j : j + 6] for j in range(max(1, len(x) - 5))} for x in lines]
    parent = list(range(len(lines)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    order = sorted(range(len(lines)), key=lambda i: len(sets[i]))
    for a, i in enumerate(order):
        for j in order[:a][::-1]:
            if len(sets[j]) < 0.8 * len(sets[i]):
                break
            if similar(sets[i], sets[j]):
                parent[find(i)] = find(j)
    first = {}
    for k, line in enumerate(lines):
        r = find(k)
        first[r] = min(first.get(r, (1 << 62, 0)), place[line])
    keep = set(first.values())
    out = []
    for i, t in docs:
        own = (t or "").split("\n") if t else []
        stay = {n for n in range(len(own)) if (i, n) in keep and own[n].strip()}
        left = [x for n, x in enumerate(own) if n in stay or not x.strip()]
        if not stay and any(x.strip() for x in own):
            left = []
        out.append((i, len(own), len(left), "\n".join(left)))
    return out


def test_table_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_lines, r.n_kept, r.kept_text) for r in op4_line_dedup(spark, sf_dir).collect())
    want = sorted(plain(docs))
    assert sum(w[1] - w[2] for w in want) > 50
    assert got == want


def test_edited_lines_nulls_blanks_and_repeats(spark):
    rng = random.Random(11)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(400)]
    base = [rng.choices(vocab, k=rng.randrange(1, 40)) for _ in range(40)]
    docs = []
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(5)):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            lines.append(rng.choice([" ", "\t "]).join(w).title() if rng.random() < 0.3 else " ".join(w))
            if rng.random() < 0.2:
                lines.append(rng.choice(["", "  "]))
        docs.append((i, "\n".join(lines)))
    docs += [(500, None), (501, ""), (502, "\n\n"), (503, "é"), (504, "É\nab"), (505, docs[3][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, kept int").repartition(4)
    got = sorted((r.doc_id, r.n_lines, r.n_kept, r.text or "") for r in dedup_lines(df).collect())
    assert got == sorted(plain(docs))
    assert dedup_lines(df).columns == ["doc_id", "text", "kept", "n_lines", "n_kept"]
    assert dedup_lines(df.filter("false")).count() == 0
    twice = spark.createDataFrame([(1, "a line\nother"), (1, "a line\nother"), (None, "a line")], "doc_id long, text string")
    assert sorted(r.text for r in dedup_lines(twice).collect()) == ["a line", "other", "other"]


def test_bands_find_pairs_at_the_threshold():
    rng = random.Random(2)
    found = total = 0
    for _ in range(400):
        a = "".join(rng.choices("abcdefghijklmnop ", k=rng.randrange(30, 400)))
        b = list(a)
        for _ in range(max(1, len(a) // 70)):
            b[rng.randrange(len(b))] = "#"
        b = "".join(b)
        x, y = shingle_set(a, 6), shingle_set(b, 6)
        j = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        if j >= 0.8:
            total += 1
            keys = band_keys([a, b], LineParams())
            found += bool((keys[0] == keys[1]).any())
    assert total > 200 and found / total > 0.99


def test_forest_links_dense_and_chained_lines():
    lines = ["x" * 50 + str(i) for i in range(300)] + ["completely different words here"] * 1
    sets = [shingle_set(x, 6) for x in lines]
    pairs = list(jaccard_forest(sets, 0.8))
    none = np.empty(0, np.uint64)
    assert sorted(jaccard_forest([none, sets[0], none, sets[0]], 0.8)) == [(0, 2), (1, 3)]
    assert len(pairs) < len(lines)
    for a, b in pairs:
        i = len(np.intersect1d(sets[a], sets[b]))
        assert i / (len(sets[a]) + len(sets[b]) - i) >= 0.8 - 1e-9


def test_rounds_and_hot_keys_change_nothing(spark):
    """Small chunks, two destinations a round and keys that are hot from two lines on: the same lines stay."""
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdefgh ", k=60)) for _ in range(40)]
    docs = [(i, "\n".join(rng.choice(base)[: rng.randrange(55, 60)] + rng.choice("xyz") for _ in range(12))) for i in range(60)]
    docs += [(100 + i, f"the same notice for everyone, number {i:03d}, please read it with care and sign it below") for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    want = {r.doc_id: r.text for r in dedup_lines(df).collect()}
    got = {r.doc_id: r.text for r in dedup_lines(df, LineParams(fan=2, heavy=2, chunk_lines=40)).collect()}
    assert got == want and sum(bool(want[100 + i]) for i in range(150)) < 20


def test_a_hot_bucket_is_copied_a_few_times_and_loses_no_link(spark):
    """Numbers that link at a distance of 1: one dense run and some far ones, in blocks of 8."""
    rng = random.Random(4)
    values = list(range(300)) + [1000, 1001, 5000, 9000, 9001, 9003]
    rng.shuffle(values)
    rows = [(b, i, v) for b in (1, 2) for i, v in enumerate(values)] + [(3, 0, values[0]), (3, 1, values[1])]
    seen = spark.sparkContext.accumulator(0)

    def linker(load):
        seen.add(len(load))
        order = sorted(range(len(load)), key=load.__getitem__)
        return [(a, b) for a, b in zip(order, order[1:]) if load[b] - load[a] <= 1]

    df = spark.createDataFrame(rows, "bucket long, id long, v long")
    roots = {r.node: r.root for r in connected_components(bucket_edges(df, "v", linker, 8)).collect()}
    group = lambda v: roots.get(values.index(v), values.index(v))
    assert len({group(v) for v in range(300)}) == 1 and group(1000) == group(1001) and group(9000) == group(9001)
    assert len({group(v) for v in (0, 1000, 5000, 9000, 9003)}) == 5


def test_copies_of_a_dense_bucket(spark):
    """Of 20,000 rows that the first reaches, none is sent more than twice, whatever the number of blocks."""
    seen = spark.sparkContext.accumulator(0)

    def linker(load):
        seen.add(len(load))
        return [(0, i) for i in range(1, len(load))]

    df = spark.range(20_000).select(F.lit(1).cast("long").alias("bucket"), "id", F.col("id").alias("v"))
    assert bucket_edges(df, "v", linker, 64).count() >= 19_999
    assert seen.value < 2 * 20_000 + 400


def test_few_edges_take_few_rounds_and_many_tasks_lose_nothing(spark, monkeypatch):
    """A path of 3000 nodes in any order, stars and pairs: two rounds in one task, the same result in many."""
    rng = random.Random(12)
    path = list(range(3000))
    rng.shuffle(path)
    pairs = list(zip(path, path[1:])) + [(5000, 5000 + i) for i in range(1, 400)] + [(9001, 9000), (9000, 9001), (7, 7)]
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(5)
    want = {i: 0 for i in range(3000)} | {5000 + i: 5000 for i in range(400)} | {9000: 9000, 9001: 9000}
    written = []
    monkeypatch.setattr(common, "materialize", lambda df, label, f=common.materialize: written.append(label) or f(df, label))
    assert {r.node: r.root for r in connected_components(edges).collect()} == want
    assert len(written) <= 3
    monkeypatch.setattr(common, "_EDGES", 300)
    assert {r.node: r.root for r in connected_components(edges).collect()} == want
    names = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y")], "u string, v string")
    assert {(r.node, r.root) for r in connected_components(names).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}


def test_groups_of_lines_are_verified_in_one_sort(monkeypatch):
    """Random groups in several alphabets have the components of the definition; no line gets a set of its own."""
    rng = random.Random(14)
    asked = []
    monkeypatch.setattr(lines, "shingle_set", lambda *a: asked.append(a) or shingle_set(*a))
    for alphabet in ("abcdefgh ", "ab", "aé\xff\x00 ", "абвгд ", "語言模型学ab"):
        for _ in range(60):
            base = ["".join(rng.choices(alphabet, k=rng.randrange(6, 60))) for _ in range(3)]
            group = []
            for _ in range(rng.randrange(2, 12)):
                x = list(rng.choice(base))
                for _ in range(rng.randrange(3)):
                    x[rng.randrange(len(x))] = rng.choice(alphabet)
                group.append("".join(x) + rng.choice(alphabet) * rng.randrange(3))
            sets = [{x[j : j + 6] for j in range(len(x) - 5)} for x in group]
            up = list(range(len(group)))
            for a in range(len(group)):
                for b in range(a):
                    if similar(sets[a], sets[b]):
                        up = [up[b] if u == up[a] else u for u in up]
            got = list(range(len(group)))
            links = list(line_forest(group, LineParams()))
            for a, b in links:
                got = [got[b] if u == got[a] else u for u in got]
            assert {(a, b) for a in range(len(up)) for b in range(a) if up[a] == up[b]} == {(a, b) for a in range(len(up)) for b in range(a) if got[a] == got[b]}
            assert len(links) < len(group)
    assert not asked
    many = "".join(map(chr, range(0x4E00, 0x4E00 + 300)))
    assert len(list(line_forest([many, many + "x", many + "y", "short"], LineParams()))) == 2 and asked


def test_lines_in_the_compared_form_with_and_without_odd_spaces():
    for text in ("a b  c\n x\ty ", "\x85 A\x1cB\r\n \u3000", "  ", "\n", " x\n\u200b y ", " \n a", ""):
        assert normal_lines(text) == [" ".join(x.split()) for x in text.lower().split("\n")]
    assert {chr(c) for c in range(0x110000) if chr(c).isspace()} == {*lines._SPACES, " ", "\n"}


def test_lines_that_meet_in_differing_company_are_verified_in_few_groups(spark, monkeypatch):
    """What the bands of a line find is one group, not one for each set of lines; the same lines stay."""
    rng = random.Random(21)
    base = ["".join(rng.choices("abcdefgh ", k=90)) for _ in range(12)]
    docs = []
    for i in range(240):
        x = list(base[i % 12])
        for _ in range(3):
            x[rng.randrange(90)] = rng.choice("xyz")
        docs.append((i, "".join(x)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = []
    monkeypatch.setattr(lines, "bucket_edges", lambda members, *a, f=bucket_edges, **b: rows.append(members.count()) or f(members, *a, **b))
    got = sorted((r.doc_id, r.n_lines, r.n_kept, r.text) for r in dedup_lines(df).collect())
    assert got == sorted(plain(docs))
    keys = band_keys([t for _, t in docs], LineParams())
    found = {}
    for i, own in enumerate(keys.tolist()):
        for k in own:
            found.setdefault(k, set()).add(i)
    assert 0 < rows[0] < 0.8 * sum(map(len, {frozenset(x) for x in found.values() if len(x) > 1}))


def test_large_groups_by_counts_and_by_search_agree(monkeypatch):
    rng = random.Random(22)
    base = ["".join(rng.choices("abcdefgh ", k=50)) for _ in range(20)]
    group = [x[: rng.randrange(42, 51)] + rng.choice("xyz") for x in base for _ in range(12)]
    rng.shuffle(group)

    def parts():
        up = list(range(len(group)))
        links = list(line_forest(group, LineParams()))
        for a, b in links:
            up = [up[b] if u == up[a] else u for u in up]
        return [up.index(u) for u in up], len(links)

    by_counts = parts()
    monkeypatch.setattr(lines, "_PRODUCTS", 0)
    assert parts() == by_counts and len(set(by_counts[0])) == len(group) - by_counts[1]
    monkeypatch.setattr(lines, "_PRODUCTS", 1 << 60)
    assert lines._common(np.repeat(np.arange(3), 2), np.array([0, 1, 0, 1, 1, 2]), 3, 3).tolist() == [[2, 2, 0], [2, 3, 1], [0, 1, 1]]


def test_shingles_hash_alike_in_lines_of_bytes_and_of_wider_letters():
    for size in (1, 3, 6, 8, 9):
        p = LineParams(shingle=size)
        narrow = ["h\u00e9llo w\u00f6rld, this is a line", "ab", "", "\xff" * 20, "x"]
        alone = band_keys(narrow, p)
        assert (alone == band_keys([*narrow, "\u8a9e\u8a00\u6a21\u578b\u5b66\u4e60\u5f88\u6709\u610f\u601d"], p)[: len(narrow)]).all()
        assert all((band_keys([x], p) == alone[i]).all() for i, x in enumerate(narrow))
    deltas = np.array([3, 3, 70_000, 1 << 40, (1 << 63) + 5], np.uint64)
    for k in range(1, 6):
        assert (lines._unsteps(lines._steps(deltas[:k])) == deltas[:k]).all()


def test_output_of_bytes_odd_blanks_and_a_repeated_id(spark):
    docs = [(1, "one line here\n\u00a0\n\u3000\none line here\n"), (2, "one line here"), (3, "\u00e9t\u00e9\n\u00c9T\u00c9\nother"), (3, "\u00e9t\u00e9\n\u00c9T\u00c9\nother"), (4, "\n\n")]
    got = sorted((r.doc_id, r.n_lines, r.n_kept, r.text) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    twice = (3, 3, 2, "\u00e9t\u00e9\nother")
    assert got == [(1, 5, 4, "one line here\n\u00a0\n\u3000\n"), (2, 1, 0, ""), twice, twice, (4, 3, 3, "\n\n")]


def test_more_lines_than_two_bytes_number():
    links = list(line_forest(["abcdef", *["ghijkl"] * 70_000], LineParams(shingle=2)))
    assert len(links) == 69_999 and {b for _, b in links} == set(range(2, 70_001))
