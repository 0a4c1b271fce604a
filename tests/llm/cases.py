"""Small hard documents, and helpers the tests of this folder share."""

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names operators use inside.
CLASH = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, cell string, row string, ids string, start string, fp string, g string, n string, u string, v string, _rid string, _rid_file string, _spans string, spans string, kept string, _text string, rest string"
EXTRA = tuple("q" for _ in CLASH.split(", ")[5:])


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(n))


def hard_rows(seed=1):
    rng = random.Random(seed)
    base = words(rng, 120)
    texts = [None, "", " ", "\n\t", "x", base, base, base + " tail", "é ß 梦 😀  two  spaces \n x ", words(rng, 3000), words(rng, 400, "ab"), "a" * 5000, "- - -", "a b", "A B", base.upper()]
    rows = [(i, t, None if i % 3 else "en", "src0" if i % 2 else None, None) for i, t in enumerate(texts)]
    rows += [(5, base, None, None, 1), (5, base, None, None, 1), (None, "x y z", None, None, None), (None, None, None, None, None)]
    rows += [(100 + i, words(rng, rng.randint(1, 300)), "en", "src1", 5) for i in range(40)]
    return rows


def hard_docs(spark, seed=1):
    return spark.createDataFrame(hard_rows(seed), DOCS)


def clash_docs(spark, seed=1):
    return spark.createDataFrame([r + EXTRA for r in hard_rows(seed)], CLASH)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def folder(spark, tmp_path, docs, **tables):
    """A data folder with ``documents`` and other tables."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
