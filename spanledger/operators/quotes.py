"""Quotes found verbatim in texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a quote by which texts are looked up before the whole quote is compared.
KEY = 12
#: UTF-8 bytes of quotes up to which their keys are broadcast.
BROADCAST_BYTES = 4 << 20
#: Bytes that a listed quote has besides its text; characters by which short quotes are looked up beyond the bound.
ROW_BYTES, GRAM = 32, 3


def containment(docs: DataFrame, quotes: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """item_id, doc_id, start (first place, in characters) of every quote (item_id, text) that a text (doc_id, text) holds.

    A quote's longest word is looked up among the distinct words of a text by an equi-join, broadcast while the quotes
    are few; only texts that have the word are searched for the quote.
    """
    words = lambda c: F.filter(F.split(c, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    inner = F.slice(words("text"), F.lit(2), F.greatest(F.size(words("text")) - 2, F.lit(0)))
    longest = F.get(F.array_sort(inner, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)), 0)
    keyed = quotes.select("item_id", F.col("text").alias("quote"), longest.alias("word"))
    total = keyed.agg(F.sum(F.octet_length("quote"))).first()[0] or 0
    short = keyed.filter("word IS NULL").drop("word")
    keyed = keyed.filter("word IS NOT NULL")
    hint = F.broadcast if total <= BROADCAST_BYTES else lambda df: df
    # the lookup carries ids only; texts come back for what was found
    have = docs.select("doc_id", F.explode(F.array_distinct(words("text"))).alias("word")).join(hint(keyed.select("word", "item_id")), "word").select("doc_id", "item_id").distinct()
    pairs = have.join(hint(keyed.drop("word")), "item_id").join(docs.select("doc_id", "text"), "doc_id")
    pairs = pairs.select("doc_id", "item_id", "quote", "text")
    if short.head(1):  # quotes of two words or fewer have no inner word: a short list is held against each text
        if (short.agg(F.sum(F.octet_length("quote") + ROW_BYTES)).first()[0] or 0) <= most_bytes:
            listed = short.agg(F.collect_list(F.struct("item_id", "quote")).alias("all"))
            more = docs.select("doc_id", "text").join(F.broadcast(listed)).select("doc_id", F.explode("all").alias("q"), "text").select("doc_id", "q.item_id", "q.quote", "text")
        else:  # a long one is looked up by the first characters of a word, which must stand within a word of the text
            own = short.withColumn("gram", F.substring(F.array_max(words("quote")), 1, GRAM))
            grams = lambda w: F.flatten(F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.substring(w, i, n))))
            held = docs.select("doc_id", F.explode(F.array_distinct(words("text"))).alias("word")).select("doc_id", F.explode(grams(F.col("word"))).alias("gram")).distinct()
            found = held.join(own.filter("gram IS NOT NULL").select("gram", "item_id"), "gram").select("doc_id", "item_id").distinct()
            more = found.join(own.drop("gram"), "item_id").join(docs.select("doc_id", "text"), "doc_id").select("doc_id", "item_id", "quote", "text")
            # a quote without a word stands within one run of other characters, and is looked up by its first ones; an empty one is in every text
            bare = own.filter("gram IS NULL AND quote IS NOT NULL").select("item_id", "quote", F.substring("quote", 1, GRAM).alias("gram"))
            runs = F.array_distinct(F.filter(F.split("text", r"[\p{L}\p{N}]+"), lambda r: r != ""))
            gaps = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", F.explode(grams(F.col("run"))).alias("gram")).distinct()
            if bare.filter("quote = ''").head(1):
                gaps = gaps.unionByName(docs.select("doc_id", F.lit("").alias("gram")))
            found = gaps.join(bare.select("gram", "item_id"), "gram").select("doc_id", "item_id").distinct()
            more = more.unionByName(found.join(bare.drop("gram"), "item_id").join(docs.select("doc_id", "text"), "doc_id").select("doc_id", "item_id", "quote", "text"))
        pairs = pairs.unionByName(more)
    return pairs.filter(F.contains("text", "quote")).select("item_id", "doc_id", (F.instr("text", F.col("quote")) - 1).cast("bigint").alias("start"))
