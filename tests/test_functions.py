"""Text views and similarities on hand-made strings."""

import random
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from linkloom.functions import rich_text, similarity, text

NAMES = [
    ("Acme Foods Ltd.", "acme foods ltd ", "acme foods ltd", "acme foods"), ("  ACME, Limited & Foods Inc", " acme limited foods inc", "acme ltd foods inc", "acme   foods"),
    ("Société Générale (Pvt) Ltd", "societe generale pvt ltd", "societe generale pvt ltd", "societe generale"), ("Zenith-Motors Corporation", "zenith motors corporation", "zenith motors corp", "zenith motors"),
    ("Co", "co", "co", ""), (None, "", "", ""), ("   ", " ", "", ""), ("日本 Trading Co", "日本 trading co", "日本 trading co", "日本 trading"), ("Co-op Corporate Group", "co op corporate group", "co op corporate group", "op corporate group"),
]
ADDRESSES = [
    ("12 Main Road, Pune 411001, India", "12 main rd pune 411001 india", "12", "411001"), ("No. 0042 Rue de la Paix", "no 0042 rue de la paix", "0042", ""), ("100000-7 Rd", "100000 7 rd", "100000", "100000"),
    ("PO 12345-6789", "po 12345 6789", "12345", "12345"), ("Flat 1234567 X", "flat 1234567 x", "123456", ""), ("5th Ave", "5th ave", "5", ""), (None, "", "", ""),
]


def test_names(spark):
    df = spark.createDataFrame([(k, r[0]) for k, r in enumerate(NAMES)], "k int, t string")
    got = df.select("k", text.name(F.col("t")), text.name_heavy(F.col("t")), text.name_core(F.col("t"))).orderBy("k").collect()
    assert [tuple(r)[1:] for r in got] == [r[1:] for r in NAMES]


def test_addresses(spark):
    df = spark.createDataFrame([(k, r[0]) for k, r in enumerate(ADDRESSES)], "k int, t string").select("k", text.address(F.col("t")).alias("a"))
    got = df.select("k", "a", text.house(F.col("a")), text.postal(F.col("a"))).orderBy("k").collect()
    assert [tuple(r)[1:] for r in got] == [r[1:] for r in ADDRESSES]


def test_accents_follow_the_unicode_tables(spark):
    chars = [chr(c) for c in [*range(0xC0, 0x250), *range(0x370, 0x400), *range(0x1E00, 0x1F00)] if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    got = spark.createDataFrame([(k, c) for k, c in enumerate(chars)], "k int, t string").select("k", text.strip_accents(F.col("t")).alias("s")).orderBy("k").collect()
    want = ["".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x)[0] != "M") for c in chars]
    assert [r.s for r in got] == want


def test_similarities_equal_duckdb(spark):
    random.seed(5)
    pairs = [tuple("".join(random.choice("abcdé 日") for _ in range(random.randint(0, 18))) for _ in range(2)) for _ in range(1500)] + [("martha", "marhta"), ("", ""), ("", "acme"), ("abcdefghij", "abcdxxxxxx"), ("sharma traders", "traders sharma")]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    got = {r.k: (r.j.jaro, r.j.jaro_winkler, r.l) for r in df.select("k", similarity.jaro_pair(F.col("a"), F.col("b")).alias("j"), similarity.levenshtein_ratio(F.col("a"), F.col("b")).alias("l")).collect()}
    con = duckdb.connect()
    con.execute("create table p (k int, a varchar, b varchar)")
    con.executemany("insert into p values (?, ?, ?)", [(k, *p) for k, p in enumerate(pairs)])
    for k, *want in con.execute("select k, jaro_similarity(a, b), jaro_winkler_similarity(a, b), 1.0 - levenshtein(a, b)::double / greatest(length(a), length(b), 1) from p").fetchall():
        assert got[k] == pytest.approx(want, abs=1e-9), pairs[k]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_ratio_family():
    random.seed(6)
    for _ in range(300):
        a, b = ("".join(random.choice("abc ") for _ in range(random.randint(0, 14))) for _ in range(2))
        assert similarity.common_subsequence(a, b) == lcs(a, b)
        for f in similarity.RATIOS.values():
            assert 0 <= f(a, b) <= 1
        if len(a) < len(b) and a:  # the best stretch, by trying all
            stretches = [b[max(0, j - len(a)) : j] for j in range(1, len(b) + len(a))]
            every = max(2 * lcs(a, s) / (len(a) + len(s)) for s in stretches)
            assert similarity.partial_ratio(a, b) == pytest.approx(every)
    assert similarity.token_sort_ratio("fuzzy wuzzy bear", "bear fuzzy wuzzy") == 1.0
    assert similarity.token_set_ratio("acme foods", "acme foods limited") == 1.0
    assert similarity.ratio("acme", "acme") == 1.0 and similarity.ratio("ab", "cd") == 0.0
    assert similarity.partial_token_set_ratio("acme x", "acme y") == 1.0


def test_ratios_of_missing_names(spark):
    df = spark.createDataFrame([(None, "a"), ("", ""), ("a b", "b a")], "a string, b string")
    assert [r.r.token_sort_ratio for r in df.select(similarity.ratios(F.col("a"), F.col("b")).alias("r")).collect()] == [0.0, 0.0, 1.0]


RICH = [
    ("Café “Zürich” & Söhne GmbH", "cafe zurich and sohne gmbh"), ("A+B  @ C", "a and b at c"), ("ﬁne—print…", "fine print"), ("STRASSE ß", "strasse ss"), ("under_score", "under_score"), (None, ""), ("x​y z", "xy z"),
]


def test_clean_text(spark):
    df = spark.createDataFrame([(k, r[0]) for k, r in enumerate(RICH)], "k int, t string")
    assert [r.c for r in df.select("k", rich_text.clean_folded(rich_text.fold(F.col("t"))).alias("c")).orderBy("k").collect()] == [r[1] for r in RICH]


def test_rich_views(spark):
    df = spark.createDataFrame(
        [("S1-1", "Acme Private Limited Holdings", "007 North Road 560001, ZIP 12345-6789 and 123456789", "USA"), ("S1-2", "pvt ltd", None, None), ("S1-3", "ab", "0", "Utopia"), ("S1-4", "Big Big Co Limited", "", " ")],
        "entity_id string, business_name string, business_address string, country string",
    )
    rows = {r.entity_id: r for r in rich_text.prepare(df).collect()}
    a = rows["S1-1"]
    assert (a.name_heavy, a.name_core, a.country, a.house) == ("acme pvt ltd holding", "acme", "united states", "7")
    assert a.addr_heavy == "7 n rd 560001 zip 12345 6789 and 123456789"
    assert a.postals == ["560001", "12345", "12345-6789", "123456"]
    assert (rows["S1-2"].name_core, rows["S1-2"].postals, rows["S1-2"].country) == ("", [], "")
    assert (rows["S1-3"].name_grams, rows["S1-3"].house, rows["S1-3"].country) == (["ab"], "0", "utopia")
    assert rows["S1-4"].name_core == "big" and rows["S1-4"].addr_grams == []


def test_grams_are_thinned(spark):
    long = "".join(chr(97 + k % 26) + chr(97 + k // 26) for k in range(60))
    got = spark.createDataFrame([(long,)], "t string").select(rich_text.grams(F.col("t")).alias("g")).first().g
    every = [long[i : i + 4] for i in range(len(long) - 3)]
    assert got == list(dict.fromkeys(every[int(i * (len(every) / 40))] for i in range(40)))


def test_match_lists(spark):
    raw = [None, "", "nan", "None", "S2-1, S3-2;S2-1", " S2-9 "]
    got = spark.createDataFrame([(k, r) for k, r in enumerate(raw)], "k int, r string").select("k", rich_text.match_list(F.col("r")).alias("m")).orderBy("k").collect()
    assert [r.m for r in got] == [[], [], [], [], ["S2-1", "S3-2"], ["S2-9"]]


def test_partial_ratio_of_equal_lengths_is_symmetric():
    assert similarity.partial_ratio("abqq", "zabz") == similarity.partial_ratio("zabz", "abqq") == pytest.approx(2 / 3)


def test_batches_equal_the_plain_ratios():
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "öster", "x", "ab", "ba", "corporation", "limited", "12", "日本"]
    pairs = [(" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))), " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for _ in range(400)]
    pairs += [("".join(rng.choice("abc ") for _ in range(rng.randint(1, 90))), "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))) for _ in range(300)]
    pairs += [("".join(rng.choice("abcd") for _ in range(n)), "".join(rng.choice("abcd") for _ in range(n))) for n in (1, 2, 5, 30, 63, 64, 65, 100) for _ in range(12)]
    for name, plain in similarity.RATIOS.items():
        got = similarity.BATCHES[name](pairs)
        assert [round(x, 9) for x in got.tolist()] == [round(plain(a, b), 9) for a, b in pairs], name
        assert [round(x, 9) for x in similarity.BATCHES[name]([p[::-1] for p in pairs]).tolist()] == [round(x, 9) for x in got.tolist()], name
