from __future__ import annotations

import os
import random
import re

from llm.helpers import ODD, documents, empty, odd, prose
from transitlens.llm import common
from transitlens.llm import line_dedup as L


def words(line):
    return [w for w in re.split(r"[\W_]+", line.lower()) if w]


def removed(spark, rows):
    docs = documents(spark, rows)
    got = L.dedup(docs, removed_col="gone")
    assert got.columns == [*docs.columns, "gone"]
    return {r.doc_id: (r.text, r.gone) for r in got.collect()}


def test_equal_lines_keep_the_first(spark):
    lines = [prose(i, 12) for i in range(8)]
    rows = [(1, "\n".join(lines[:4]), None, None), (2, "\n".join([lines[0].upper() + "!!", lines[5], "", "---", lines[5]]), None, None),
            (3, "\n".join([lines[6], lines[1], lines[7]]), None, None)]
    got = removed(spark, rows)
    assert got[1] == (rows[0][1], 0)
    assert got[2] == (f"{lines[5]}\n\n---", 2)
    assert got[3] == (f"{lines[6]}\n{lines[7]}", 1)


def test_fuzzy_lines(spark):
    """Lines within the distance, against all pairs, for a long line with an edited word."""
    rng, rows = random.Random(3), []
    base = prose(1, 90).replace("\n", " ").split()
    for i in range(40):
        line = list(base)
        line[rng.randrange(len(line))] = "other%d" % i
        rows.append((i, " ".join(line) + "\n" + prose(100 + i, 12), None, None))
    got = removed(spark, rows)
    kept = [i for i, t, _, _ in rows if len(got[i][0].split("\n")) == 2]
    # Every line that went is similar to one that stays or went, along links within the distance.
    hashes = {r.doc_id: r.simhash for r in L.occurrences(documents(spark, rows).select("doc_id", "text")).filter("pos = 0").collect()}
    root = {i: i for i, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if a < b and bin((hashes[a] ^ hashes[b]) & (1 << 64) - 1).count("1") <= L.DISTANCE:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert kept == sorted({find(i) for i in root}) and len(kept) < 40


def test_simhash(spark):
    """Each place has the majority of the words' hash bits."""
    row = spark.createDataFrame([(1, "alpha beta gamma beta delta")], "doc_id long, text string")
    got = L.occurrences(row).first().simhash
    hashes = [r.h for r in spark.sql("SELECT xxhash64(w) h FROM (SELECT explode(array('alpha', 'beta', 'gamma', 'beta', 'delta')) w)").collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert got & (1 << 64) - 1 == want


def test_short_words_count(spark):
    """Words of any length are in the SimHash, so that lines without long ones are compared as well."""
    row = spark.createDataFrame([(1, "a bb ccc bb delta")], "doc_id long, text string")
    hashes = [r.h for r in spark.sql("SELECT xxhash64(w) h FROM (SELECT explode(array('a', 'bb', 'ccc', 'bb', 'delta')) w)").collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert L.occurrences(row).first().simhash & (1 << 64) - 1 == want
    base = [chr(0xAC00 + 37 * i) + chr(0xB098 + 11 * i) for i in range(150)]  # Korean words of two letters
    rows = [(1, " ".join(base), None, None)] + [(2 + i, " ".join([*base[:i * 9], "새말", *base[i * 9 + 1:]]), None, None) for i in range(16)]
    got = removed(spark, rows)
    assert sum(gone for _, gone in got.values()) > 8


def apart(a, b):
    """Edit distance in words."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_all_similar_lines_go(spark):
    """Lines of any length with as many edits as the similarity allows, against all pairs."""
    rng, lines = random.Random(11), []
    for n in [*range(3, 16), *range(16, 80, 7)]:
        base = [("w%d" if rng.random() < 0.7 else "of%d") % (rng.randrange(10_000) if rng.random() < 0.7 else rng.randrange(4)) for _ in range(n)]
        lines.append(base)
        for extra in (0, 0, 0, 1):  # one line has an edit too many
            near = list(base)
            for _ in range(int(0.2 * n + 1e-9) + extra):
                at, kind = rng.randrange(len(near)), rng.randrange(3)
                near[at:at + 1] = [["n%d" % rng.randrange(10_000)], [], [near[at], "n%d" % rng.randrange(10_000)]][kind]
            lines.append(near)
    assert L.SIMILARITY == 0.8
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for j in range(i):
            if apart(a, lines[j]) <= int(0.2 * max(len(a), len(lines[j])) + 1e-9):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    got = removed(spark, [(i, " ".join(line), None, None) for i, line in enumerate(lines)])
    assert {i for i, (_, gone) in got.items() if not gone} == {find(i) for i in root}


def test_one_word_does_not_make_a_bucket(spark):
    """Lines that have single words in common, but no word pair, are filed apart; lines themselves aren't kept."""
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 40} own{i}x{j}" for j in range(10)), None, None) for i in range(40)]
    signed = L._signed(documents(spark, rows).select("doc_id", "text"))
    assert "line" not in signed.columns and signed.count() == 40
    assert sum(L._shared(signed, k).count() for k in range(L.PASSES)) == 0


def test_edits_that_make_a_line_longer(spark):
    """The longer line allows an edit more than the shorter one, and its edits break the word pairs that come first."""
    rows = []
    for n in (4, 9, 14, 19):
        base = [f"common{j}" if j % 2 else f"word{n}x{j}" for j in range(n)]
        near, edits = list(base), (n + 1) // 5
        for e in range(edits - 1):  # changed words, and one that is new
            near[4 * e + 2] = f"new{n}x{e}"
        near.insert(n - 1, f"more{n}")
        rows += [(2 * n, " ".join(base), None, None), (2 * n + 1, " ".join(near), None, None)]
    assert {i: gone for i, (_, gone) in removed(spark, rows).items()} == {i: i % 2 for i, *_ in rows}


def test_counts_rule_pairs_out(spark):
    """Lines that say other words an even number of times have equal parities, but not counts; similar lines always pass."""
    rng, lines = random.Random(6), []
    for k in range(6):
        lines.append(" ".join(" ".join([f"w{k}x{j}"] * 40) for j in range(7)) + " " + "of " * 20)
    for n in (10, 40, 90, 9_000):
        base = [f"v{rng.randrange(30)}" for _ in range(n)]
        lines.append(" ".join(base))
        for edits in (1, n // 5):
            near = list(base)
            for _ in range(edits):
                at, kind = rng.randrange(len(near)), rng.randrange(3)
                near[at:at + 1] = [[f"u{rng.randrange(9)}"], [], [near[at], "of"]][kind]
            lines.append(" ".join(near))
    long = lambda n: " ".join(["again"] * n)
    lines += [long(40_000), long(36_000)]  # counts above 15 bits
    found = L._signed(documents(spark, [(i, t, None, None) for i, t in enumerate(lines)]).select("doc_id", "text")).collect()
    number = {spark.range(1).select(L.F.xxhash64(L.F.lit(t))).first()[0]: i for i, t in enumerate(lines)}
    rows = spark.createDataFrame([(number[r.raw], r.n, *[r[c] for c in L._counts()]) for r in found],
                                 "i int, n int, " + ", ".join(f"{c} long" for c in L._counts()))
    x, y = (rows.select(*[L.F.col(c).alias(f"{p}_{c}") for c in rows.columns]) for p in "xy")
    got = {(r.x_i, r.y_i) for r in x.crossJoin(y).filter("x_i < y_i").filter(L._possible("x_", "y_")).select("x_i", "y_i").collect()}
    assert not {(a, b) for a, b in got if b < 6}
    assert (len(lines) - 2, len(lines) - 1) in got
    short = [i for i, t in enumerate(lines) if len(words(t)) < 300]
    assert {(a, b) for a in short for b in short if a < b
            and apart(words(lines[a]), words(lines[b])) <= int(0.2 * max(len(words(lines[a])), len(words(lines[b]))) + 1e-9)} <= got
    assert {(15, 16), (15, 17)} <= got  # the longest line and its edits


def test_a_word_pair_does_not_make_a_bucket(spark):
    """Pairs of words meet by chance more often as tables grow; lines that share pairs, but no three words in a row, are filed apart."""
    rows = [(i, " ".join(f"a{x} b{x}" for x in ((i + j * (i + 1)) % 41 for j in range(6))), None, None) for i in range(20)]
    signed = L._signed(documents(spark, rows).select("doc_id", "text"))
    assert signed.count() == 20 and sum(L._shared(signed, k).count() for k in range(L.PASSES)) == 0


def test_a_pair_is_made_in_few_of_its_buckets(spark, monkeypatch):
    """Lines that share many buckets are made a pair in the first ones only."""
    base = [f"w{j}" for j in range(80)]
    rows = [(i, " ".join([*base[:15 * i + 3], f"new{i}", *base[15 * i + 4:]]), None, None) for i in range(5)]
    signed = L._signed(documents(spark, rows).select("doc_id", "text"))
    shared = L._in_passes(lambda k: L._shared(signed, k, 1), "test-shared", 1)
    assert shared.count() > 100
    made, widest = [], L._widest
    monkeypatch.setattr(L, "_widest", lambda pairs: made.append(pairs.count()) or widest(pairs))
    pairs = L._crossings(L._open(signed, shared, spark.createDataFrame([], "id long, component long"), 0, 1))
    assert pairs.count() == 10 and made[0] <= 30  # of 10 pairs with 30 buckets or more each
    # Parts make no pair again that another part makes.
    parts = [L._crossings(L._open(signed, shared, spark.createDataFrame([], "id long, component long"), k, 4)) for k in range(4)]
    assert L.reduce(L.DataFrame.unionByName, parts).distinct().count() == 10 and sum(made[1:]) == made[0]


def test_the_bound_is_compiled(spark):
    """A method of more than 8,000 bytes is interpreted by the JVM, many times slower."""
    rows = "bucket long, component long, id long, n int, " + ", ".join(f"{c} long" for c in L._counts())
    signed = L.stored(spark.createDataFrame([], rows), "test-signed")
    shared, found = L.stored(signed.select("bucket", "id"), "test-shared"), L.stored(signed.select("id", "component"), "test-found")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for df in (L._crossings(L._open(signed, shared, found, 0, 1)), L._led(signed, shared, found, 0, 1)):
            code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            assert max(int(m) for m in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_short_lines_meet_by_pairs(spark):
    """Lines of four to seven words with one edit, wherever it is."""
    rows = []
    for n in range(4, 8):
        for at in range(n + 1):
            for kind in range(3):
                base = [f"w{n}x{at}x{kind}x{j}" for j in range(n)]
                new = [] if kind == 1 else [f"new{n}x{at}x{kind}"]  # a word less, or another or one more
                near = [*base[:at], *new, *base[at + (kind != 2):]]
                if near != base and max(len(base), len(near)) >= 5 and min(len(base), len(near)) >= 4:
                    rows += [(2 * len(rows), " ".join(base), None, None), (2 * len(rows) + 1, " ".join(near), None, None)]
    got = removed(spark, rows)
    assert [got[i][1] for i, *_ in rows] == [0, 1] * (len(rows) // 2)


def test_parts_of_the_buckets_find_the_same(spark, monkeypatch):
    """Small tables take one part, larger ones several; the lines that go are the same."""
    lines = [prose(i, 12) for i in range(30)]
    rows = [(i, line + "\n" + line.replace(line.split()[4], f"new{i}"), None, None) for i, line in enumerate(lines)]
    done = []
    whole = L._in_passes
    monkeypatch.setattr(L, "_in_passes", lambda part, name, parts: done.append(parts) or whole(part, name, parts))
    one = removed(spark, rows)
    assert set(done) == {1}
    monkeypatch.setattr(L, "PART", 25)
    assert removed(spark, rows) == one and set(done) == {1, 3}
    assert sum(gone for _, gone in one.values()) >= 25


def test_lines_with_too_many_runs_of_their_own_go(spark):
    """Lines that share a few runs of words are filed under none; similar ones are, under no more than they need."""
    rows = [(i, " ".join([*(f"own{i}x{j}" for j in range(14)), "in", "the", "end", "of", "it"]), None, None) for i in range(30)]
    base = [f"w{j}" for j in range(20)]
    rows += [(100, " ".join(base), None, None), (101, " ".join([*base[:9], "new", *base[10:]]), None, None), (102, "a b a b a b a b a b a b", None, None)]
    words = L._words(documents(spark, rows).select("doc_id", "text"))
    shared = L._in_passes(lambda k: L._shared(words, k, 2), "test-shared", 2)
    assert shared.select("id").distinct().count() == 32  # a run that a line has several times, and no other, doesn't count
    left = L._narrowed(shared).groupBy("id").count().collect()
    assert len(left) == 2 and all(r["count"] <= 3 * 4 + 1 - 3 for r in left)
    assert sum(gone for _, gone in removed(spark, rows).values()) == 1


def test_crowded_buckets_draw_few_lines(spark):
    """Lines outside a bucket's large component are compared with a few of its lines, however many it has."""
    for size in (100, 1000):
        members = {b: range(size + 20) for b in (1, 2)} | {3: range(2000, 2100), 4: [*range(L.CROWD), 5000]}
        crowded = spark.createDataFrame([(b, i) for b, ids in members.items() for i in ids], "bucket long, id long")
        # Lines 20 and on are one component, 2000 and on are pairs.
        components = spark.createDataFrame([(i, 20) for i in range(20, size + 20)] + [(i, i // 2 * 2) for i in range(2000, 2100)], "id long, component long")
        got = L._drawn(crowded, components).collect()
        drawn = {r.a for r in got}
        assert {r.b for r in got} == set(range(20)) and drawn <= set(range(20, size + 20))
        assert 5 < len(drawn) <= L.LEADERS and len(got) == 20 * len(drawn)


def test_lines_of_candidates(spark, monkeypatch):
    """Places that lines share in the bitmap bring in others, but no wrong line; lines of no candidate don't move."""
    rows = documents(spark, [(i, prose(i, 12) + "\n" + prose(500 + i, 12), None, None) for i in range(60)] + [(99, None, None, None)])
    lines = rows.filter("text IS NOT NULL").select(L.F.explode(L.F.split("text", "\n")).alias("line"))
    wanted = lines.limit(9).select(L.F.xxhash64(L.F.upper("line")).alias("id"), L.F.xxhash64("line").alias("_raw"), "line")
    wanted = L.stored(wanted, "test-wanted")
    for places in (L.PLACES, 128):
        monkeypatch.setattr(L, "PLACES", places)
        got = {r.id: r.line for r in L._lines_of(rows, wanted.select("id", "_raw")).collect()}
        assert got == {r.id: r.line for r in wanted.collect()} and len(got) == 9


def test_only_what_is_read_later_stays(spark, monkeypatch):
    """The tables of all steps go; the result reads the removals."""
    made, write = [], common.shared_path
    monkeypatch.setattr(common, "shared_path", lambda *a, **b: made.append(write(*a, **b)) or made[-1])
    lines = [prose(i, 12) for i in range(30)]
    rows = [(i, line + "\n" + line.replace(line.split()[4], f"new{i}"), None, None) for i, line in enumerate(lines)]
    got = L.dedup(documents(spark, rows))
    left = [p for p in made if os.path.exists(p.removeprefix("file:"))]
    assert len(made) > 20 and len(left) == 1 and "/lines-removals/" in left[0]
    assert sum(len(r.text.split("\n")) == 1 for r in got.collect()) >= 25


def test_odd_rows(spark):
    got = L.dedup(odd(spark)).collect()
    assert len(got) == len(ODD)
    texts = sorted(str((r.doc_id, r.text)) for r in got)
    want = list(ODD)
    want[5] = (4, "", None, None)  # the repeated row loses its line
    assert texts == sorted(str((i, t)) for i, t, _, _ in want)
    assert L.dedup(empty(spark)).count() == 0


def test_no_python(spark):
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        L.dedup(documents(spark, [(1, "a b c\na b c", None, None)])).explain()
    assert not re.search("Python|Pandas|Arrow", out.getvalue())
