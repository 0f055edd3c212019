"""Character sets: frequencies, dictionaries and encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed values.
SPECIAL = ("<unk>", "<pad>", "<blank>")
JAMO = "ㄱㄴㄷㄹㅁㅂㅅㅇㅈㅊㅋㅌㅍㅎㅏㅑㅓㅕㅗㅛㅜㅠㅡㅣㄲㄸㅃㅆㅉ"
PUNCTUATION = ".:/-()[]~&+*#@,·%'\"\\ "
SYMBOLS = "△○●×✓→"
#: Shift codes of each industry.
CODES = {
    "hospital": "낮 밤 저녁 오전 오후 야간 주간 당직 오프 휴무 반차 연차 대휴 보상 출장 재택 교육 정상 D E N A B C OFF OT AL SL CL PH D당직 E당직 N당직",
    "convenience": "조 중 석 야 오픈 마감 미들 클로징 풀타임 파트 OP CL MD FT PT 06 09 12 15 18 21 24",
    "factory": "주간 야간 교대 비번 휴무 특근 잔업 조출 A조 B조 C조 D조 1조 2조 3조 4조",
    "office": "정상 재택 반차오전 반차오후 연차 출장 외근 교육 휴직 재 반 연 출 외",
    "food": "Open Close Mid Full Part",
}


def characters(texts: DataFrame, column: str = "text") -> DataFrame:
    """ch: each character, as often as it occurs."""
    return texts.select(F.explode(F.split(column, "")).alias("ch")).where("ch != ''")


def frequencies(texts: DataFrame, column: str = "text") -> DataFrame:
    """ch, count."""
    return characters(texts, column).groupBy("ch").agg(F.count("*").alias("count"))


def by_frequency(freq: DataFrame) -> DataFrame:
    return freq.orderBy(F.desc("count"), "ch")


def hangul(spark: SparkSession) -> DataFrame:
    """All syllables from U+AC00 to U+D7A3."""
    code = F.lpad(F.hex("id"), 4, "0")
    return spark.range(0xAC00, 0xD7A4).select(F.decode(F.unhex(code), "UTF-16BE").alias("ch"))


def base(spark: SparkSession) -> DataFrame:
    """ch, source: the characters of a dictionary before any annotation is seen."""
    fixed = spark.createDataFrame([(c, "base_charset") for c in dict.fromkeys(JAMO + "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + PUNCTUATION)], "ch string, source string")
    domain = spark.createDataFrame([(c, "domain_knowledge") for c in dict.fromkeys("".join(CODES.values()).replace(" ", ""))], "ch string, source string")
    every = hangul(spark).select("ch", F.lit("base_charset").alias("source")).unionByName(fixed).unionByName(domain)
    # What the domain names is called so, even if it is a plain letter.
    return every.groupBy("ch").agg(F.max("source").alias("source"))


def payroll_charset(spark: SparkSession) -> DataFrame:
    return base(spark).select("ch")


def dictionary(spark: SparkSession, freq: DataFrame, attention: bool = False) -> DataFrame:
    """idx, token: all characters in code-point order (what annotation has, and symbols seen there, included), then the
    special tokens; <bos> and <eos> come before these."""
    seen = freq.select("ch")
    every = payroll_charset(spark).union(seen).distinct()
    special = (("<bos>", "<eos>") if attention else ()) + SPECIAL
    order = Window.partitionBy(F.lit(0)).orderBy("ch")  # a dictionary's size does not grow with the data
    chars = every.select((F.row_number().over(order) - 1).alias("idx"), F.col("ch").alias("token"))
    n = chars.agg(F.count("*").alias("n"))
    tail = spark.createDataFrame(list(enumerate(special)), "k int, token string").join(F.broadcast(n))
    return chars.unionByName(tail.select((F.col("n") + F.col("k")).cast("int").alias("idx"), "token"))


def vocabulary_size(attention: bool = False) -> int:
    words = set("".join(CODES.values()).replace(" ", "")) | set(JAMO) | set(PUNCTUATION)
    letters = {chr(c) for a, b in ((65, 91), (97, 123), (48, 58)) for c in range(a, b)}
    hangul_ = 0xD7A4 - 0xAC00
    return hangul_ + len({c for c in words | letters if not 0xAC00 <= ord(c) < 0xD7A4}) + len(SPECIAL) + 2 * attention


def symbols_seen(freq: DataFrame) -> DataFrame:
    spark = freq.sparkSession
    return spark.createDataFrame(list(enumerate(SYMBOLS)), "pos int, ch string").join(freq, "ch", "left_semi").orderBy("pos")


def frequency_table(vocab: DataFrame, freq: DataFrame) -> DataFrame:
    """token, count (0 if unseen), source: annotation before domain before base."""
    spark = vocab.sparkSession
    out = vocab.join(freq.withColumnRenamed("ch", "token"), "token", "left").join(base(spark).withColumnRenamed("ch", "token"), "token", "left")
    return out.select("token", F.coalesce("count", F.lit(0)).alias("count"), F.when(F.col("count") > 0, "annotation").otherwise(F.coalesce("source", F.lit("special"))).alias("source"))


def duplicated(tokens: DataFrame, order: str = "idx") -> DataFrame:
    """Tokens seen more than once, by where they came the second time."""
    w = Window.partitionBy("token").orderBy(order)
    return tokens.withColumn("_k", F.row_number().over(w)).where("_k = 2").orderBy(order).select("token")


def dictionary_issues(tokens: DataFrame, freq: DataFrame) -> DataFrame:
    """issue, token: annotated characters that are missing, tokens that come twice, a last token that isn't <blank>."""
    missing = freq.join(tokens.select(F.col("token").alias("ch")), "ch", "left_anti").select(F.lit("missing_character").alias("issue"), F.col("ch").alias("token"))
    twice = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_token").alias("issue"), "token")
    last = tokens.agg(F.max(F.struct("idx", "token")).alias("l")).where("l.token != '<blank>'").select(F.lit("last_token_not_blank").alias("issue"), F.col("l.token").alias("token"))
    return missing.unionByName(twice).unionByName(last)


def encode(text: Column, index: dict[str, int]) -> Column:
    """The index of each character, that of <unk> (or 0) for others. The index is a dictionary, of a fixed size."""
    table = F.create_map(*[F.lit(x) for kv in index.items() for x in kv])
    unknown = F.lit(index.get("<unk>", 0))
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.coalesce(F.try_element_at(table, c), unknown))


def meta(tokens: DataFrame, freq: DataFrame) -> DataFrame:
    """One row: size of the dictionary, characters seen, places of the special tokens."""
    return tokens.agg(F.count("*").alias("vocab_size"), *(F.max(F.when(F.col("token") == s, F.col("idx"))).alias(s.strip("<>")) for s in SPECIAL)).join(F.broadcast(freq.agg(F.count("*").alias("annotation_chars"), F.sum("count").alias("annotation_total"))))
