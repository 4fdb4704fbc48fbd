"""SimHash, embeddings, line dedup and components, against brute force."""

import numpy as np
import pyarrow as pa
import xxhash
from llm_cases import by_id, empty, messy

from tallyworks.llm.components import connected_components, forest
from tallyworks.llm.embedding_dedup import embedding_near_duplicates
from tallyworks.llm.line_dedup import SKETCH_BITS, _tiles, _verify, dedup_lines, member_tokens, occurrences, prefix_entries, sketch
from tallyworks.llm.line_sets import Powers, line_sets
from tallyworks.llm.simhash import fingerprints, links_of, near_duplicates, one_of_each


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    pairs += [tuple(map(int, p)) for p in rng.integers(200, 400, (120, 2))] + [(500, 500), (None, 3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    known = [p for p in pairs if None not in p]
    want = roots(known, {x for p in known for x in p})
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == {n: c for n, c in want.items() if n != c}
    a, b = forest(*np.array(known).T)
    assert roots(zip(a.tolist(), b.tolist()), want) == want
    assert connected_components(df.limit(0), "a", "b").count() == 0


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    values = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum((2 * sum(v >> b & 1 for v in values) > len(values)) << b for b in range(64))


def test_fingerprints(spark):
    got = {(r.doc_id, r.fp) for r in fingerprints(messy(spark)).collect()}
    from llm_cases import TEXTS

    assert got == {(i, (f := fingerprint(t)) - (1 << 64) * (f >> 63)) for i, t in TEXTS}


def test_links_within_two_bits(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = set(base.tolist())
    for b in base.tolist():
        for _ in range(12):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            values.add(b ^ sum(1 << int(f) for f in flips))
    # a key that holds many fingerprints: all differ in the low 16 bits only
    values |= {(0xABCDEF << 40) | int(x) for x in rng.choice(1 << 16, 700, replace=False)}
    fps = np.array(sorted(values), np.uint64)
    df = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64).tolist())], "fp long, rep long")
    for radius in (1, 2, 3):
        pairs = [(i, int(j)) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius) if j < i]
        links = [(r.a, r.b) for r in links_of(df, radius).collect()]
        want = roots(pairs, range(len(fps)))
        assert roots(links, range(len(fps))) == want, radius


def test_near_duplicates_of_odd_rows(spark):
    got = by_id(near_duplicates(messy(spark)))
    assert got[2].fingerprint == got[3].fingerprint == "0" * 16
    assert got[2].component_id == got[3].component_id == got[4].component_id == 2
    assert got[1].component_id == got[5].component_id == 1 and got[8].component_id == 8
    null = [r for r in near_duplicates(messy(spark)).collect() if r.doc_id is None]
    assert [r.component_id for r in null] == [1]
    kept = one_of_each(messy(spark))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "6", "7", "8"]
    assert kept.columns == messy(spark).columns and near_duplicates(empty(spark)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, rep int, size int")


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 32))
    for k in range(60):
        x[100 + k] = x[k % 20] + rng.normal(size=32) * 0.08
    x[200:320] = x[0] + rng.normal(size=(120, 32)) * 0.1  # one large group
    x[330:340] = x[5]
    x = x.astype(np.float32)
    rows = [(i, [float(v) for v in row], 1, None, None) for i, row in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, [None] * 32), (904, []), (905, [1.0, 2.0]), (906, [2.0, 4.0])]
    got = by_id(embedding_near_duplicates(vectors(spark, rows + [(i, v, 1, None, None) for i, v in odd]), block=50), "vec_id")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    n = links.sum(1)
    found = np.array([got[i].n_links for i in range(400)])
    assert (found <= n).all() and found.sum() >= 0.95 * n.sum()
    want = roots(zip(*np.nonzero(links)), range(400))
    assert sum(got[i].component_id == want[i] for i in range(400)) >= 395
    for i in range(900, 905):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[905].n_links == got[906].n_links == 1 and got[906].component_id == 905 and not got[906].kept
    assert embedding_near_duplicates(vectors(spark, [])).count() == 0


def brute_lines(texts):
    lines = []
    for k, (i, text) in enumerate(texts):
        for n, line in enumerate((text or "").encode().lower().split(b"\n")):
            if words := frozenset(line.split()):
                lines.append((i, text, n, words))
    lines = sorted({(i, text, n): w for i, text, n, w in lines}.items())
    gone = set()
    for b, (key, words) in enumerate(lines):
        if any(len(words & w) >= 0.8 * len(words | w) - 1e-9 for _, w in lines[:b]):
            gone.add(key)
    return {(i, text): "\n".join(line for n, line in enumerate(text.split("\n")) if (i, text, n) not in gone) for i, text in texts if text}


def test_lines_against_brute_force(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{int(k)}" for k in rng.zipf(1.4, 400) % 300]
    pool = [" ".join(rng.choice(vocabulary, rng.integers(1, 30))) for _ in range(60)]
    texts = []
    for i in range(50):
        lines = []
        for _ in range(rng.integers(1, 9)):
            words = pool[rng.integers(len(pool))].split()
            for _ in range(rng.integers(0, 3)):
                words[rng.integers(len(words))] = f"new{rng.integers(40)}"
            lines.append(" ".join(words))
        texts.append((i, "\n".join(lines)))
    got = {r.doc_id: r.text for r in dedup_lines(messy(spark, texts)).collect()}
    assert got == {i: t for (i, _), t in brute_lines(texts).items()}


def test_lines_of_odd_rows(spark):
    df = dedup_lines(messy(spark))
    rows = df.collect()
    assert len(rows) == 10 and df.columns[: len(messy(spark).columns) - 1] == [c for c in messy(spark).columns if c != "n_links"]
    got = by_id(df)
    assert got[2].text is None and got[3].text == "" and got[4].text == " \n\t " and got[2].n_lines == 0
    assert [r.text for r in rows if r.doc_id == 1] == ["One two three four five six seven."] * 2
    assert [r.text for r in rows if r.doc_id is None] == [""]  # equal to a line of document 1
    assert dedup_lines(empty(spark)).count() == 0


def test_many_copies_of_a_line(spark):
    texts = [(i, f"a b c d e\nx{i} y{i}") for i in range(300)]
    got = by_id(dedup_lines(messy(spark, texts)))
    assert got[0].n_removed == 0 and all(got[i].text == f"x{i} y{i}" for i in range(1, 300)) and got[7].n_links == 299


def test_a_text_is_split_once_however_many_lines_it_has(spark):
    """Not again for each line that is kept; lines of repeated rows are made distinct once."""
    df = spark.createDataFrame([(1, "a b c\nd e f\n\ng h i"), (1, "a b c\nd e f\n\ng h i"), (2, "d e f\nx y z\nx y z\nlast")], "doc_id long, text string")
    got = dedup_lines(df)
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed, r.n_links) for r in got.collect()) == [
        (1, "a b c\nd e f\n\ng h i", 3, 0, 1), (1, "a b c\nd e f\n\ng h i", 3, 0, 1), (2, "x y z\nlast", 4, 2, 3),
    ]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1 and "lambdafunction(get(split" not in plan, plan


def test_a_token_of_one_line_alone_is_not_sent_to_be_compared(spark):
    """Nothing of a line goes through the shuffle for tokens that no second line has."""
    near = [f"{' '.join(f'common{k}' for k in range(20))} own{i}" for i in range(2)]
    docs = spark.createDataFrame([(i, i, text) for i, text in enumerate([" ".join(f"only{k}" for k in range(50)), *near])], "doc_id long, text_key long, text string")
    found = occurrences(docs)
    assert sorted((r.doc_id, r.lines) for r in found.filter("chunk is null").collect()) == [(0, [0]), (1, [0]), (2, [0])]
    counts = sketch(found)
    assert counts.sum() == 50 + 21 * 2 and len(counts) == 1 << SKETCH_BITS
    rows = prefix_entries(docs, spark.sparkContext.broadcast(counts), 4, 0.8).collect()
    sizes = [n for r in rows for n in np.frombuffer(r.n, np.int32).tolist()]
    assert sizes and set(sizes) == {21}  # the two near lines by tokens that both have, the other by none
    got = by_id(dedup_lines(docs.select("doc_id", "text")))
    assert [(got[i].n_removed, got[i].n_links) for i in range(3)] == [(0, 0), (0, 1), (1, 1)]


def test_only_the_first_place_of_a_line_with_candidates_is_cut_again(spark):
    docs = spark.createDataFrame([(i, 7, f"a b c\nx{i} y z") for i in range(40)], "doc_id long, text_key long, text string")
    lines = next(line_sets(pa.array(["a b c"]), Powers()))
    members = spark.createDataFrame([(int(lines.classes()[0]), 0, (3, 7, 0), 40)], "class long, component long, rank struct<doc_id:long,text_key:long,line:int>, copies long")
    rows = member_tokens(docs.repartition(8), members).collect()
    assert [(r["class"], bytes(r.tokens)) for r in rows] == [(int(lines.classes()[0]), lines.tokens.tobytes())]


def test_tiles_against_brute_force():
    """Tiles that are cut by the ends of batches, with classes that come twice, one block empty."""
    rng = np.random.default_rng(11)
    rows = []
    for component in range(30):
        known = [np.unique(rng.integers(0, 7, rng.integers(1, 25)).astype(np.uint64)) for _ in range(rng.integers(1, 20))]
        one = component % 3 == 0  # all in block 0, none in block 1
        for k, tokens in enumerate(known):
            own, doc = 0 if one else k % 2, int(rng.integers(5))
            for other in (0, 1):
                row = (component, min(own, other), max(own, other), 100 * component + k, own, doc, -k, k, k + 1, tokens.tobytes())
                rows += [row] * int(rng.integers(1, 3))
    rows.sort(key=lambda r: r[:4])
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    got = {}
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 7]), kinds)], names=list("abcdefghij")) for k in range(0, len(rows), 7)]
    for columns in _tiles(batches):
        for c, n, earlier in zip(*(x.tolist() for x in _verify(*columns, 0.6))):
            a, b = got.get(c, (0, False))
            got[c] = a + n, b or earlier
    want = {}
    lines = {r[3]: (r[0], r[5:8], r[8], frozenset(np.frombuffer(r[9], np.uint64).tolist())) for r in rows}
    for a, (ca, place, _, sa) in lines.items():
        for b, (cb, first, copies, sb) in lines.items():
            if a != b and ca == cb and len(sa & sb) >= 0.6 * len(sa | sb) - 1e-9:
                n, earlier = want.get(a, (0, False))
                want[a] = n + copies, earlier or first < place
    assert got == want and len(want) > 20
