import random
import re
import zlib
from collections import Counter

from helpers import docs, odd_rows

from gaugeloom.llm import spelling


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    return {w: n for w, n in counts.items() if n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(counts):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x.encode()), default=None)
        out[w] = (best if best and counts[best] >= 2 * n else None, n, len(near))
    rows = {}
    for w, (form, n, k) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, n, k, counts[form] if form else None)
    return rows


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_words_and_odd_rows(spark):
    rows = [*odd_rows(), *[(i, "Straße STRASSE naïveté ×÷×÷× WORDS words' wordsé Ångström aaaaaa") for i in range(900)]]
    rows += [(None, "Words words words"), (7, "x" * 200_000 + " " + "yyyyy " * 50)]
    table = docs(spark, rows)
    wanted = brute_words(rows)
    assert {r.word: r.n for r in spelling.words(table).collect()} == wanted
    assert "aaaaa" in wanted  # runs that have lost a code point
    assert result(spelling.variants(spelling.words(table))) == brute(wanted)
    assert spelling.variants(spelling.words(table.where("false"))).count() == 0


def test_near_words_against_brute_force(spark):
    r = random.Random(5)
    counts = {}
    for letters in ("ab", "abc", "éaß"):
        for _ in range(120):
            word = "".join(r.choice(letters) for _ in range(r.choice((5, 5, 6, 6, 7, 8, 11, 12, 13))))
            counts[word] = r.choice((3, 3, 5, 6, 7, 12, 13, 30, 100))
    stem = "".join(r.choice("abcdef") for _ in range(60))
    counts |= {stem: 50, stem[:30] + stem[31:]: 20, stem + "a": 9, "b" + stem: 4, stem[:59] + "x": 101}
    # chains: counts double at each step
    counts |= {"q" * 9 + "p" * k: 3 * 2**k for k in range(12)}
    wanted = brute(counts)
    got = result(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)))
    assert got == wanted
    assert any(k > 5 for _, _, _, k, _ in wanted.values())
    assert wanted["q" * 9][1] == "q" * 9 + "p" * 11


def test_every_single_edit_is_met(spark):
    words = ["abcde", "abcdef", "abcdefg", "abcdefghijkl", "abcdefghijklm"]
    for word in words:
        edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
        edits |= {word[:i] + "z" + word[i + j :] for i in range(len(word) + 1) for j in (0, 1)}
        edits = sorted(e for e in edits if len(e) >= 4)
        table = spark.createDataFrame([(word, 9), *((e, 3) for e in edits)], "word string, n long")
        pairs = {frozenset((r.word, r.other)) for r in spelling.near_pairs(table).collect()}
        for e in edits:
            # words of four code points are too short for the operator but their chunks still meet
            assert frozenset((word, e)) in pairs, (word, e)


def test_common_halves_meet_in_small_groups(spark):
    from pyspark.sql import functions as F

    r = random.Random(1)
    table = spark.createDataFrame([("andan" + "".join(r.choice("abcdefghij") for _ in range(6)), 3) for _ in range(3000)], "word string, n long")
    keys = table.dropDuplicates(["word"]).select(F.explode(spelling._keys(F.col("word"), True)).alias("key"))
    assert keys.groupBy("key").count().agg(F.max("count")).first()[0] < 100


def test_no_side_is_sent_through_the_driver(spark, tmp_path):
    """The files of a vocabulary are far smaller than its exploded chunks, so their size must not decide."""
    r = random.Random(2)
    counts = {"".join(r.choice("abcdefghij") for _ in range(7)): r.choice((3, 7, 50)) for _ in range(2000)}
    spark.createDataFrame(list(counts.items()), "word string, n long").write.parquet(str(tmp_path / "vocabulary"))
    table = spark.read.parquet(str(tmp_path / "vocabulary"))
    for df in (spelling.near_pairs(table), spelling.variants(table)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert result(spelling.variants(table)) == brute(counts)
