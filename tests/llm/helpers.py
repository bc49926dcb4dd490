"""Small fixtures with the awkward cases every operator must handle."""

from pyspark.sql import types as T

TEXTS = [None, "", " ", "one", "one two three four", "Ünï cödé  漢字 🙂 ok", "a b c d e f g h i j k l",
         "A B C D E F G H I J K L", "rep eat rep eat rep eat rep eat rep eat rep eat",
         "line one\nline one\n\nline two\r\n#$% <tag> | x", "word " * 30_000, "a b c d e f g h i j k l"]


def docs(spark, texts=None, extra=True):
    """doc_id, text and columns whose names clash with the operators' own."""
    texts = TEXTS if texts is None else texts
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    rows = [(i, t) for i, t in enumerate(texts)]
    if extra:
        fields += [T.StructField(n, T.StringType()) for n in ("word", "kept", "hash", "score", "n_words", "rep", "key")]
        rows = [r + ("x",) * 7 for r in rows]
    return spark.createDataFrame(rows, T.StructType(fields))
