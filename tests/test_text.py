import random
import re

import pytest
from pyspark.sql import functions as F

from stemma.functions import similarity, text as tx

TITLES = [
    ("  BERT: Pre-training of Deep Models", "pretrainingofdeepmodels"), ("Towards Better Parsing", "sbetterparsing"),
    ("Edinburgh Research Explorer Parsing", "parsing"), ("Invited Talk: A: B", "b"), ("Étude de cas", "tudedecas"), ("A：B：C", "bc"),
    ("toward: x", "x"), ("Erratum to: Foo", "foo"), ("GPT-4 Report", "gpt4report"), (None, ""), ("", ""), ("  a", "a"),
]
NAMES = [
    ("Zhiyuan Liu 0001", "zhiyuan liu"), ("Smith, John", "john smith"), ("Smith, John 0002", "john 0002 smith"), ("Smith 0002, John", "john smith"),
    ("Jürgen Müller-Lüdenscheidt", "jurgen muller ludenscheidt"), ("Martin King Jr.", "martin king jr."), ("Martin King Jr", "martin king"), ("Henry V", "henry"),
    ("O'Neil, Pat", "pat oneil"), ("J. R. Smith", "j. r. smith"), ("A  B 12", "a b"), ("Dr Ana_Maria Lopez", "ana maria lopez"), (None, ""), ("", ""), ("Weiß Æon", "weiss aeon"),
]


def apply(spark, pairs, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "i int, a string").orderBy("i").select(f(F.col("a"))).collect()]


def test_title_key(spark):
    assert apply(spark, TITLES, tx.title_key) == [b for _, b in TITLES]


def test_title_key_on_random_strings(spark):
    rng = random.Random(1)
    parts = tx.TITLE_PREFIXES + [":", "：", " ", "\n", "a", "B", "é", "1", "Ünder", "%", "toward"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(400)]

    def plain(t):
        t = t.lstrip()
        for p in sorted(tx.TITLE_PREFIXES, key=len, reverse=True):
            if t.lower().startswith(p.lower()):
                t = t[len(p) :].lstrip()
                break
        for colon in ":：":
            t = t.partition(colon)[2] if colon in t else t
        return re.sub("[^a-z0-9]", "", t.lower())

    assert apply(spark, [(t, None) for t in texts], tx.title_key) == [plain(t) for t in texts]


def test_person_name(spark):
    assert apply(spark, NAMES, tx.person_name) == [b for _, b in NAMES]


def test_keys_and_identifiers(spark):
    pairs = [("john a smith", "ja smith"), ("smith", None), ("j. r. smith", "jr smith")]
    assert apply(spark, pairs, tx.initials_key) == [b for _, b in pairs]
    dois = [("https://doi.org/10.1145/123.456", "10.1145/123.456"), ("https://doi.org/10.18653/v1/2023.acl-long.1", "v1/2023.acl-long.1"), ("https://aclanthology.org/P19-1/", None)]
    assert apply(spark, dois, tx.doi_of) == [b for _, b in dois]
    likes = [("The Deep Learning of 100% things there", "%deep%learning%100\\%%"), ("a b c", None)]
    assert apply(spark, likes, tx.like_pattern) == [b for _, b in likes]
    fields = [('["A B", "C"]', ["A B", "C"]), ("A;B ; ", ["A", "B"]), ("A|B", ["A", "B"]), ("A", ["A"])]
    assert apply(spark, fields, tx.author_field) == [b for _, b in fields]
    pdf = [('{"url":"u"}', "u"), ('"x"', "x"), ("", None)]
    assert apply(spark, pdf, tx.pdf_url) == [b for _, b in pdf]
    readings = apply(spark, [("a b c", 0), ("a b", 0), ("x", 0), ("", 0)], tx.name_readings)
    assert [[tuple(x) for x in r] for r in readings] == [[("a", "c")], [("a", "b"), ("b", "a")], [("", "x")], []]


def test_abbreviations(spark):
    rows = [("j smith", "john smith", True), ("j. smith", "john smith", True), ("john smith", "john smyth", False), ("a b c", "a c", False)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean")
    assert all(r.got == r.want for r in df.select("want", tx.abbreviates(F.col("a"), F.col("b")).alias("got")).collect())


@pytest.mark.parametrize(
    "a, b, want",
    [("Attention Is All You Need", "Attention is all you need.", 1.0), ("Neural Parsing", "Neural Parsing of Trees", 0.756757), ("Deep Residual Learning", "Deep Residual Learning for Image Recognition", 0.666667), ("Graph Networks", "Bayesian Trees", 0.214286), ("", "x", 0.0), (None, "x", 0.0)],
)
def test_title_similarity(spark, a, b, want):
    assert round(similarity.title_ratio(a, b), 6) == want
    df = spark.createDataFrame([(a, b)], "a string, b string").select(similarity.title_similarity("a", "b"))
    assert round(df.first()[0], 6) == want


def test_name_scores():
    assert similarity.name_score("john smith", "smith john") == 100
    assert similarity.name_score("wei zhang", "li na") < 86
    assert similarity.name_score("jonathan smith", "jonathon smith") > 85
    assert similarity.name_score("", "x") == 0
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("ab c") for _ in range(rng.randint(0, 8))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert similarity.common_subsequence(a, b) == table[-1][-1]


def test_scores_of_a_batch_equal_those_of_each_pair():
    rng = random.Random(8)
    parts = ["ann", "an", "bo", "li", "j", "j.", "garcia", "garcía", "lopez", "x" * 40, "李", "de", " ", "  "]
    name = lambda: " ".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))
    a, b = ([name() if rng.random() < 0.95 else rng.choice([None, "", " "]) for _ in range(1500)] for _ in range(2))
    a[:200] = ["".join(rng.choice("abcd .") for _ in range(rng.randint(0, 70))) for _ in range(200)]
    b[:200] = ["".join(rng.choice("abcd .") for _ in range(rng.randint(0, 140))) for _ in range(200)]
    want = [similarity.name_score(x, y) for x, y in zip(a, b, strict=True)]
    assert similarity.name_scores(a, b).tolist() == want
    for least in (60, 85, 95):
        got = similarity.name_scores(a, b, least).tolist()
        assert all(g == w if w > least else g <= least for g, w in zip(got, want, strict=True))


def test_subsequences_of_a_batch():
    rng = random.Random(2)
    pairs = [("".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 90]))), "".join(rng.choice("abc") for _ in range(rng.randint(0, 100)))) for _ in range(400)]
    a, b = map(list, zip(*pairs, strict=True))
    assert similarity.common_subsequences(a, b).tolist() == [similarity.common_subsequence(x, y) for x, y in pairs]


def test_plain_names_take_the_short_way_to_the_same_result(spark):
    rng = random.Random(8)
    words = ["Ann", "bo7", "Li", "Jr", "PhD", "iv", "V", "V.", "Jra", "A.", "12", "1234", "12345", "7", "O'Neil", "Smith-Jones", "José", "x,y", "", "\n", "\t", "٣", "ſ", "K"]
    names = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(3000)] + ["", None, "Ann\n", "Ann Li 12\n", " Ann", "Ann  Li", "12", "Jr", "jr."]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(tx.person_name(F.col("n")).alias("a"), tx._any_person_name(F.col("n")).alias("b"), tx._is_plain(F.col("n")).alias("plain"))
    rows = df.collect()
    assert all(r.a == r.b for r in rows) and 100 < sum(bool(r.plain) for r in rows) < 2000
