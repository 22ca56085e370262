"""Documents with the awkward rows every operator must take, and a folder of them as tables."""

from pyspark.sql import Row

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, FINGERPRINT string, kept int, `row` string, key int"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def doc(doc_id, text, lang="en", source="a"):
    return Row(doc_id, text, lang, source, None if text is None else len(text), "x", 7, "r", 1)


ODD = [
    doc(1, None),
    doc(2, ""),
    doc(3, " \t\n "),
    doc(4, "One two three four five six seven eight nine ten.", source="b"),
    doc(5, "ONE two three four five six seven eight nine ten.", source=None),
    doc(5, "ONE two three four five six seven eight nine ten.", source=None),
    doc(None, "one two three four five six seven eight nine ten.", lang=None),
    doc(None, "nothing to see here", lang=None, source=None),
    doc(7, LONG, lang="fr"),
    doc(8, LONG.upper(), lang="fr", source="b"),
    doc(9, "É é one\nline\n\nand\nline", source="é"),
    doc(10, "12 34 !!", lang=None),
    doc(11, "日本語 テキスト <|endoftext|>", lang="ja", source="c"),
]


def odd_docs(spark):
    return spark.createDataFrame(ODD, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def real_docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
