"""URL filter, decontamination, line dedup, mixing and sharding: native plans, brute force and odd rows."""

import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import decontam, linededup, mixing, sharding, url_filter
from cohortlens.llm import queries as Q


def check_sql(spark, name, **tables):
    con = duckdb.connect()
    for t, df in tables.items():
        con.register(t, df.toPandas())
    cur = con.execute(Q.SQL[name])
    cols = [d[0] for d in cur.description]
    return cols, sorted(cur.fetchall(), key=str)


@pytest.fixture(scope="module")
def pages(spark):
    hosts = ["a.example.com", "B.Example.NET", "x.co.uk", "spam.org", "spam.org", "net", "plain"]
    rng = random.Random(1)
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/x', '/de/?q', '/fr/#f', '?a/b'])}") for i in range(300)]
    rows += [(300, None), (301, ""), (302, "no scheme/en/"), (303, "http://"), (303, "HTTP://a://b/c"), (None, "http://spam.org/fr/")]
    labels = [(i, int("spam" not in u and rng.random() < 0.95), 0) for i, u in rows[:200]] + [(5, 0, 0), (7, None, 1), (None, 1, 0)]
    return spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("x")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_url_filter_against_sql(spark, pages):
    got = url_filter.digest(*pages)
    cols, want = check_sql(spark, "op2_url_filter", pages=pages[0].select("page_id", "url"), labels=pages[1])
    rows = [tuple(r) for r in got.select(cols).collect()]
    norm = lambda rows: sorted((tuple(None if v != v else v for v in r) for r in rows), key=str)
    assert norm(rows) == norm([tuple(int(v) if isinstance(v, float) and v == v else v for v in r) for r in want])
    by = Counter((r["host"], r["verdict"]) for r in got.where("rule IS NULL").collect())
    assert by[("spam.org", "block")] and not by[("spam.org", "allow")] and by[("a.example.com", "allow")]


def test_url_rules(spark):
    urls = ["http://a.net/", "http://a.net", "https://Sub.Example.NET/en/1", "http://example.net/de/", "http://notexample.com/de/", "http://example.com/de/x?y", "http://w.org/fr/", "http://org/fr/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(df, spark.createDataFrame([], "page_id long, bad int")).collect()}
    assert got == {0: ("net/", "block"), 1: (None, "allow"), 2: ("example.net/en/", "allow"), 3: ("net/", "block"), 4: (None, "allow"),
                   5: ("example.com/de/", "block"), 6: ("org/fr/", "allow"), 7: ("org/fr/", "allow")}
    assert url_filter.judge(df.limit(0), spark.createDataFrame([], "page_id long, bad int")).collect() == []


def similarity(a, b):
    k = min(5, len(a), len(b))
    sh = lambda w, k: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    x, y = sh(a, min(5, len(a))), sh(b, min(5, len(b)))
    return sum((x & y).values()) / sum((x | y).values()) if k else 0


def leaks(spark):
    """Documents with exact, edited, torn and foreign passages; the words are random, so every match is planted."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    items = [[word() for _ in range(n)] for n in (14, 25, 36, 36, 59, 3)]
    docs = []
    for i in range(80):
        body = [word() for _ in range(rng.randrange(0, 120))]
        item = list(rng.choice(items))
        kind = i % 5
        if kind == 1:
            item[rng.choice([1, len(item) // 2])] = word()
        if kind == 2:
            item.insert(rng.choice([1, len(item) // 3]), word())
        if kind == 3:
            item = item[: len(item) // 2]
        if kind == 4:
            item = [word() for _ in item]
        at = rng.randrange(len(body) + 1)
        docs.append(body[:at] + item + body[at:])
    text = lambda w: ", ".join(w).title()
    return items, docs, spark.createDataFrame([(i, text(w)) for i, w in enumerate(docs)], "doc_id long, text string"), \
        spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(90, None), (91, "")], "item_id long, text string")


@pytest.mark.parametrize("literals", [50_000, 3])
def test_decontamination_against_all_windows(spark, monkeypatch, literals):
    monkeypatch.setattr(decontam, "MOST_LITERALS", literals)
    items, docs, df, bench = leaks(spark)
    found = decontam.digest(df, bench).collect()
    want = {}
    for d, w in enumerate(docs):
        for i, item in enumerate(items):
            best = max((similarity(w[s : s + len(item)], item) for s in range(max(1, len(w) - len(item) + 1))), default=0)
            if best >= 0.8:
                want[d, i] = round(best, 6)
    assert len(want) > 20 and {(r.doc_id, r.item_id): r.similarity for r in found} == want
    kept = decontam.decontaminate(df.withColumn("__t", F.lit(1)), bench)
    assert kept.columns == ["doc_id", "text", "__t"]
    assert {r.doc_id for r in kept.collect()} == set(range(80)) - {d for d, _ in want}


def test_block_index_guarantees_the_radius(spark):
    rng = random.Random(4)
    pairs = []
    for k in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), k % (decontam.RADIUS + 1)):
            b ^= 1 << bit
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        pairs.append((k, signed(a), signed(b)))
    df = spark.createDataFrame(pairs, "k int, a long, b long")
    near = df.select("k", F.col("a").alias("fp")).select("k", F.explode(decontam._block_values(True)).alias("v"))
    own = df.select("k", F.col("b").alias("fp")).select("k", F.explode(decontam._block_values(False)).alias("v"))
    assert near.join(own, ["k", "v"]).select("k").distinct().count() == 200


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def found_links(spark, rows, steps):
    """Linked lines, of one line a document."""
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    distinct = linededup.lines(docs)
    line = {r.id: rows[r["first"].doc_id] for r in distinct.collect()}
    found = [frozenset((line[r.a], line[r.b])) for r in linededup.links(docs, distinct, steps).collect()]
    assert len(found) == len(set(found))
    return set(found)


def all_links(rows, steps):
    """Every two lines within the distance that the longer one allows, by comparing all pairs of like lengths."""
    out, most = set(), max(t for _, t in steps)
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if abs(len(a) - len(b)) <= most:
                t = max((s for s in steps if s[0] <= max(len(a), len(b))), default=(0, -1))[1]
                if t >= 0 and edit_distance(a, b) <= t:
                    out.add(frozenset((a, b)))
    return out


def edited(rng, s, k, letters):
    s = list(s)
    for _ in range(k):
        i, kind = rng.randrange(len(s)), rng.randrange(3)
        if kind == 0:
            s[i] = rng.choice(letters)
        elif kind == 1 and len(s) > 1:
            del s[i]
        else:
            s.insert(i, rng.choice(letters))
    return "".join(s)


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_line_links_against_all_pairs(spark, threshold):
    rng = random.Random(threshold)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(20, 50))) for _ in range(30)]
    rows = sorted({*base, *(edited(rng, b, rng.randrange(1, 5), "abcé") for b in base for _ in range(4))})
    want = all_links(rows, ((20, threshold),))
    assert (want or not threshold) and found_links(spark, rows, ((20, threshold),)) == want


@pytest.mark.parametrize("steps", [linededup.STEPS, ((8, 1), (20, 2), (64, 4), (128, 8), (200, 16))])
@pytest.mark.parametrize("kind", ["short words", "long words", "no spaces"])
def test_no_link_is_lost(spark, steps, kind):
    """Lines with as many edits as their length allows, one fewer and one more, in one place or spread over the line; lengths around the steps."""
    rng = random.Random(kind)
    word = lambda: "".join(rng.choice("aeinrstoé") for _ in range(rng.randrange(*((10, 15) if kind == "long words" else (3, 9)))))
    rows = set()
    for size in (7, 8, 12, 19, 20, 21, 41, 64, 90, 127, 128, 129, 190, 201, 257, 300):
        for _ in range(2):
            line = ("" if kind == "no spaces" else " ").join(word() for _ in range(size))[:size]
            rows.add(line)
            t = max((s for s in steps if s[0] <= size), default=(0, 0))[1]
            for k in (t - 1, t, t, t, t + 1):
                rows.add(edited(rng, line, max(k, 0), "xyz é"))
            if t:
                at = rng.randrange(size)
                rows |= {line[:at] + "q" * t + line[at:], line[t:], line[:-t], line[: at // 2] + "zz"[:t] + line[at // 2 :]}
    rows = sorted(r for r in rows if r.strip())
    want = all_links(rows, steps)
    assert len(want) > 150 and found_links(spark, rows, steps) == want


def test_lines_with_one_word_replaced(spark):
    """Linked if, and only if, the word's characters are within the allowed edits."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeinrstou") for _ in range(rng.randrange(2, 9)))
    rows = set()
    for k in range(150):
        a = [word() for _ in range(8 + k % 110)]
        b = list(a)
        b[rng.randrange(len(b))] = "x" + word()[: max(1, sum(map(len, a)) // 60)]
        rows |= {" ".join(a), " ".join(b)}
    rows = sorted(rows)
    want = all_links(rows, linededup.STEPS)
    assert sum(edit_distance(*p) > 2 for p in want) > 30 and found_links(spark, rows, linededup.STEPS) == want


@pytest.mark.parametrize("threshold", [0, 1, 2, 5, 8, 30])
def test_banded_distance_against_the_whole_table(spark, threshold):
    rng = random.Random(threshold)
    pairs = [("", ""), ("a", ""), ("abc", "abc")]
    for _ in range(300):
        a = "".join(rng.choice("ab") if rng.random() < 0.7 else rng.choice("cdé") for _ in range(rng.randrange(0, 90)))
        pairs.append((a, edited(rng, a, rng.randrange(0, threshold + 4), "abé") if a and rng.random() < 0.8 else "".join(rng.choice("abé") for _ in a)))
    pairs = [p for p in pairs if abs(len(p[0]) - len(p[1])) <= threshold]
    rows = spark.createDataFrame(pairs, "line_a string, line_b string").selectExpr("line_a", "line_b", "split(line_a, '') AS a", "split(line_b, '') AS b")
    rows = rows.selectExpr("line_a", "line_b", "IF(line_a = '', array(), a) AS a", "IF(line_b = '', array(), b) AS b")
    got = rows.select("line_a", "line_b", F.expr(linededup.within(threshold)).alias("near")).collect()
    assert len(got) == len(pairs) > 5 and all(r.near == (edit_distance(r.line_a, r.line_b) <= threshold) for r in got)


@pytest.mark.parametrize("edits", [0, 1, 2, 3, 5, 8, 16, 30])
def test_places_are_few_and_each_segment_has_its_own(edits):
    spots = linededup.places(4 * (edits + 1), edits)
    assert len(spots) == edits * edits // 2 + edits + 1
    assert len({i for i, _, _ in spots}) == sum(shift == 0 for *_, shift in spots) == edits + 1


def test_line_dedup_texts(spark, odd):
    a = "This line is long enough to be compared."
    rows = [(1, f"{a}\nshort\n\n{a}"), (2, f"short\nshorx\n{a[:-1]}!\n \nOther words, that nobody has written before."), (3, a.replace("long", "lang")), (3, None)]
    out = {(r.doc_id, r.text): tuple(r)[2:] for r in linededup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {(1, f"{a}\nshort\n"): (3, 1, 0, 4), (2, "shorx\n \nOther words, that nobody has written before."): (4, 2, 1, 2), (3, ""): (1, 1, 1, 2), (3, None): (0, 0, 0, 0)}
    got = {r.doc_id: r for r in linededup.deduplicate(odd).collect()}
    assert got[8].text == "A b\n" and got[8].n_removed == 2 and got[6].text == "" and got[1].n_removed == 0 and got[2].text is None
    assert linededup.deduplicate(odd).count() == 10 and linededup.digest(odd.limit(0)).collect() == []


def test_mixing_against_sql(spark, prose_docs):
    docs = prose_docs.withColumn("source", F.when(F.col("doc_id") % 9 != 0, F.col("source")))
    cols, want = check_sql(spark, "op6_mixing", documents=docs.select("doc_id", "text", "source"))
    got = sorted((tuple(r) for r in mixing.digest(docs).select(cols).collect()), key=str)
    assert got == want
    rows = mixing.digest(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m"), F.first("source_size").alias("s")).collect()
    assert all(abs(r.t - r.g) <= 2 * r.m and r.g <= 3 * r.s for r in rows)
    assert sum(r.g for r in rows) == pytest.approx(sum(r.s for r in rows))


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 5), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got == {"a": 1015.0 - 30 - 15, "b": 30.0, "c": 15.0, None: 0.0}


def test_emit_repeats_documents(odd, prose_docs):
    mixed = {r.doc_id: r.copies for r in mixing.mix(prose_docs).collect()}
    emitted = Counter(r.doc_id for r in mixing.emit(prose_docs).collect())
    assert emitted == Counter({k: v for k, v in mixed.items() if v}) and max(mixed.values()) <= 3
    assert mixing.emit(odd).columns == odd.columns and mixing.mix(odd).count() == 10
    assert mixing.mix(odd.limit(0)).collect() == []


@pytest.mark.parametrize("shards", [1, 3, 24, 200])
def test_sharding_against_prefix_sums(prose, prose_docs, shards):
    rows = sharding.digest(prose_docs, shards).orderBy("doc_id").collect()
    total, before, slots = sum(len(t.encode()) + 8 for _, t in prose), 0, Counter()
    for r, (i, t) in zip(rows, prose):
        shard = before * shards // total
        assert (r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.slot, r.grown_shard) == (i, len(t.encode()) + 8, zlib.crc32(t.encode()), "bytes", shard, slots[shard], None)
        slots[shard] += 1
        before += r.size


def test_sharding_odd_rows(odd):
    out = sharding.shard_documents(odd)
    rows = out.collect()
    assert len(rows) == 10 and [c for c in out.columns if c.lower() == "size"] == ["size"]
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(odd.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op2", "op3", "op4", "op6", "op9"])
def test_native_operators_run_no_python(name):
    import pathlib

    module = {"op2": url_filter, "op3": decontam, "op4": linededup, "op6": mixing, "op9": sharding}[name]
    code = pathlib.Path(module.__file__).read_text()
    assert not any(x in code for x in ("mapIn", "pandas", "udf", ".rdd", "applyIn", "toArrow"))
