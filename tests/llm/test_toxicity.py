import pytest

from tessera.llm import toxicity as T


def scored(text, lexicon):
    return T.score_of(text, lexicon, lexicon.automaton())


def test_folding_reads_lookalikes_and_digits():
    plain = T.fold_words("You idiot and clown")
    assert T.fold_words("Y0u 1d10t and c1own!!") == plain
    assert T.fold_words("Yоu іdіоt and сlоwn") == plain  # Cyrillic letters
    assert T.fold_words("Yoú ídiöt and clówn") == plain
    assert T.fold_words("ｙｏｕ ｉｄｉｏｔ and cl​own") == plain
    assert T.fold_words("in 2024, 17%") == ["in", "2024", "17"]  # numbers stay numbers


def test_weights_exceptions_and_length():
    lexicon = T.lexicon_of({"trash": 2.0, "idiot": 4.0}, {"moro": 3.0}, ("trash can",), scale=10.0)
    machine = lexicon.automaton()
    weight = lambda s: T.weight_of(T.fold_words(s), machine)
    assert weight("you idiot, you moronic trash") == (9.0, 3)
    assert weight("put it in the trash can") == (0.0, 0)
    assert weight("trash, not the trash can") == (2.0, 1)
    assert weight("idiotic tumor") == (0.0, 0)  # whole words; stems only at the start
    assert scored("idiot", lexicon) > scored("idiot " + "word " * 100, lexicon) > 0
    assert scored("idiot " * 5000 + "x", lexicon) < 1
    assert scored(None, lexicon) == scored("", lexicon) == scored("calm words", lexicon) == 0


@pytest.fixture(scope="module")
def labelled(spark):
    rows = []
    for i in range(600):
        bad = i % 5 == 0
        words = [f"w{(i * 7 + k * 13) % 101}" for k in range(40)] + (["grumpf", "zzorkel"] if bad else ["kind"])
        rows.append((i, " ".join(words), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_learned_lexicon_separates_and_ignores_held_out_labels(spark, labelled):
    docs, labels = labelled.drop("toxic"), labelled.select("doc_id", "toxic")
    lexicon = T.learn_lexicon(docs, labels)
    assert {"grumpf", "zzorkei"} <= set(lexicon.words)
    got = T.score_documents(docs, lexicon).join(labels, "doc_id").collect()
    assert all(r["predicted"] == r["toxic"] for r in got)
    assert all(r["held_out"] == (__import__("zlib").crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    # Turned labels of held-out rows change nothing.
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.learn_lexicon(docs, turned) == lexicon


def test_exception_phrases_are_learned(spark):
    rows = []
    for i in range(2400):
        bad = i % 3 == 0
        filler = " ".join(f"w{(i * 3 + k) % 50}" for k in range(20))
        rows.append((i, f"{filler} {'you scumlord there' if bad else 'the old scumlord ballad' if i < 4 * 2 else 'hello'}", int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = T.learn_lexicon(df, df)
    if lexicon.exceptions:
        assert scored("the old scumlord ballad", lexicon) == 0
    assert scored("you scumlord there", lexicon) >= T.THRESHOLD


def test_messy_and_empty_tables(spark, messy, no_docs):
    labels = spark.createDataFrame([(0, 0), (1, 1), (1, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    lexicon = T.learn_lexicon(messy, labels)
    got = T.score_documents(messy, T.lexicon_of({"cat": 3.0})).collect()
    assert len(got) == messy.count() and all(0 <= r["score"] <= 1 for r in got)
    assert [r["predicted"] for r in got if r["doc_id"] in (0, 1)] == [1, 1, 1]
    assert all(r["score"] == 0 for r in T.score_documents(messy, lexicon).collect())
    assert T.learn_lexicon(no_docs, labels.limit(0)) == T.Lexicon()
    assert T.score_documents(no_docs, T.Lexicon()).count() == 0


def test_very_long_tokens_take_linear_time():
    import time
    began = time.process_time()
    for text in ("x" * 2_000_000, "x1" * 1_000_000, "1" * 2_000_000, "!" * 2_000_000, "é" * 1_000_000):
        T.fold_words(text)
    assert time.process_time() - began < 20


def test_more_terms_than_a_task_holds(spark):
    many = spark.createDataFrame([(" ".join(f"v{k}x{j}" for j in range(400)),) for k in range(600)], "text string").coalesce(1)
    assert T._count_terms(many, None).filter("term LIKE ' v% '").count() == 240_000


def test_rare_terms_are_not_cut_by_the_number_of_frequent_ones(spark):
    # 5,200 words in every document; the words of interest are in rejected ones only, one of them in three tenths.
    common = " ".join(f"q{k}" for k in range(5_200))
    rows = [(i, f"{common} {'zzorkel' if i % 10 == 0 else 'grumpf' if i % 3 == 0 else 'kind'}", int(i % 3 == 0 or i % 10 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
    assert {"zzorkei", "grumpf"} <= set(T.learn_lexicon(df, df).words)


def test_terms_of_a_small_language_are_kept(spark):
    # 9 of 600 rejected documents hold the term of their small language: 1.5 %, and no accepted one does.
    rows = []
    for i in range(5400):
        small, bad = i % 90 < 8, i % 9 == 0
        words = [f"{'s' if small else 'w'}{(i * 7 + k * 13) % 101}" for k in range(20)]
        term = ("zzorkel" if i % 630 == 0 else "grumpf") if bad else "kind"
        rows.append((i, " ".join([*words, term]), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
    lexicon = T.learn_lexicon(df, df)
    assert "zzorkei" in lexicon.words
    assert scored(" ".join([f"s{k}" for k in range(20)] + ["zzorkel"]), lexicon) >= T.THRESHOLD


def test_term_with_harmless_uses_is_kept_with_an_exception(spark):
    # A tenth of the accepted documents have the harmless phrase, a third of the rejected ones the bare word.
    rows = []
    for i in range(1500):
        bad = i % 3 == 0
        filler = " ".join(f"w{(i * 3 + k) % 50}" for k in range(20))
        term = ("you scumlord there" if i % 9 == 0 else "grumpf") if bad else "the old scumlord ballad" if i % 10 == 1 else "hello"
        rows.append((i, f"{filler} {term}", int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = T.learn_lexicon(df, df)
    assert {"oid scumiord", "scumiord baiiad"} <= set(lexicon.exceptions)
    assert "scumiord" in lexicon.words
    calm = " ".join(f"w{k}" for k in range(20))
    assert scored(f"{calm} you scumlord there", lexicon) >= T.THRESHOLD
    assert scored(f"{calm} the old scumlord ballad", lexicon) == 0
