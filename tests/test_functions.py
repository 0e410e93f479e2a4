import random

import pytest
from pyspark.sql import functions as F

from cantoria.functions import errors as E
from cantoria.functions import text as T
from cantoria.functions import tokens as K


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'double' if isinstance(v, float) else 'long'}" for k, v in values.items())) if values else spark.range(1)
    return row.select(column).first()[0]


TEXTS = [
    (T.normalized_key, "  It's  A \"Test\"; ok. ", "its a test ok"),
    (T.lower_key, "  A\t b ", "a b"),
    (T.numeric_skeleton_key, "Take exit 42 then the second right, twenty one miles", "take exit # then the # right twenty # miles"),
    (T.digits_as_words, "room 12 has 0", "room one two has zero"),
    (T.clean_label, "Hello, \"World\" 42!", "hello world four two"),
    (T.without_punctuation, "it's (ok)!", "it's ok"),
    (T.separated_punctuation, "Hi, you!", "Hi , you !"),
    (T.tightened_punctuation, "Hi , you !", "Hi, you!"),
    (T.only_letters, "Don't 3 stop!", "don't stop"),
    (T.auto_capitalized, "so i said. ok", "So I said. Ok"),
    (T.auto_capitalized, "So i said", "So i said"),
    (T.with_period, "done", "done."),
    (T.with_period, "done?", "done?"),
    (T.without_timestamps, "<|0|> hi <|12|> you", "hi you"),
    (T.spoken_forms, "at 3:05 me@x 5% of 6'2\"", "at 3 oh 5 me at x 5 percent of 6 feet 2 inches"),
    (T.ascii_folded, "é ß ﬁ", "e  fi"),
    (T.graphemes_normalized, "é​ “a” –\nb", 'é "a" - b'),
    (T.numbers_in_words, "$3.50, 2nd of 1,234 at 2.5", "three dollars, fifty cents, second of one thousand two hundred thirty four at two point five"),
    (T.file_stem, "/a/b.c/d.tar.gz", "d.tar"),
    (T.extracted_answer, "I think the answer is (b).", "B"),
    (T.extracted_answer, "no idea", None),
]


@pytest.mark.parametrize(("f", "given", "expected"), TEXTS, ids=[f"{f.__name__ if hasattr(f, '__name__') else 'udf'}-{i}" for i, (f, _, _) in enumerate(TEXTS)])
def test_text(spark, f, given, expected):
    assert one(spark, f(F.col("t")), t=given) == expected


def test_null_texts_stay_null(spark):
    for f, _, _ in TEXTS:
        assert one(spark, f(F.col("t")), t=None) is None


def test_number_words(spark):
    rows = spark.range(0, 1_000_000, 7919).select("id", T.cardinal_words(F.col("id")).alias("c"), T.ordinal_words(F.col("id") % 1000).alias("o")).collect()
    assert all(r.c == T._cardinal(r.id) and (r.id % 1000 == 0 or r.o == T._ordinal(r.id % 1000)) for r in rows)
    assert one(spark, T.cardinal_words(F.lit(1_000_000))) is None and one(spark, T.ordinal_words(F.lit(0))) is None
    assert one(spark, T.cardinal_words(F.lit(612_005))) == "six hundred twelve thousand five"
    assert one(spark, T.ordinal_words(F.lit(120))) == "one hundred twentieth"


def test_split_hash(spark):
    import hashlib

    for t in ("road_name::main rd", "x", ""):
        assert one(spark, T.stable_hash_mod(F.col("t"), 10000), t=t) == int(hashlib.md5(t.encode()).hexdigest(), 16) % 10000
    assert one(spark, T.stable_hash_mod(F.lit("road_name::main rd"), 10000)) == 9209


def test_identifiers(spark):
    assert one(spark, T.stem_with_span(F.lit("/x/a.wav"), F.lit(1.5), F.lit(2.25))) == "a-1500-3750"
    assert one(spark, T.replaced_last(F.lit("a-b-c"), "-", "+")) == "a-b+c"
    assert one(spark, T.length_bucket(F.lit("a b c"))) == "short"
    assert one(spark, T.canonical_entity(F.lit("North Main Street"), F.lit("road_name"))) == one(spark, T.canonical_entity(F.lit("N. Main Rd"), F.lit("road_name"))) == "dir main rd"
    assert one(spark, T.canonical_entity(F.lit("45th Ave"), F.lit("road_name"))) == "45th rd" and one(spark, T.canonical_entity(F.lit("I-95 N"), F.lit("poi_name"))) == "i95 dir"
    assert one(spark, T.canonical_entity(F.lit("Gate 12 Café"), F.lit("poi_name"))) == "gate caf"
    assert one(spark, T.lower_key(F.lit("Cafe\u0301  X"))) == "caf\u00e9 x"
    slots = F.create_map(F.lit("road_name"), F.lit("West St"), F.lit("exit_no"), F.lit("12"), F.lit("verb"), F.lit(" Turn "))
    assert one(spark, T.slot_skeleton_key(F.lit("t7"), slots)) == "t7|exit_no=#|road_name=dir rd|verb=turn"
    assert one(spark, T.sentences(F.lit("Dr. Who came. Did he? Yes!"))) == ["Dr. Who came.", "Did he?", "Yes!"]


@pytest.mark.parametrize(("ref", "hyp", "wer"), [("cot", "cat", 1.0), ("G P U", "GPU", 1.0), ("GPU", "G P U", 3.0), ("motorcycle", "ducati motorcycle", 1.0), ("ducuti motorcycle", "ducati motorcycle", 0.5), ("a b c", "a B c", 1 / 3), ("", "cat", float("inf")), ("", "", 0.0), (None, None, 0.0)])
def test_word_error_rate(spark, ref, hyp, wer):
    found = one(spark, E.rate(E.word_distance(F.col("r"), F.col("h")), F.size(E.words(F.col("r")))), r=ref, h=hyp)
    assert found == pytest.approx(wer)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_distances_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(" ".join(rng.choice("abcdé") for _ in range(rng.randint(0, 14))), " ".join(rng.choice("abcdf") for _ in range(rng.randint(0, 14)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "r string, h string")
    out = df.select("r", "h", E.word_distance(F.col("r"), F.col("h")).alias("d"), E.operations(E.words(F.col("r")), E.words(F.col("h"))).alias("o")).collect()
    for x in out:
        assert x.d == distance(x.r.split(), x.h.split()) == x.o.insertions + x.o.deletions + x.o.substitutions
        assert x.o.hits + x.o.deletions + x.o.substitutions == len(x.r.split())


def test_many_distinct_words(spark):
    words = [f"w{i}" for i in range(5000)]
    df = spark.createDataFrame([(words, words[1:] + ["new"])], "a array<string>, b array<string>")
    assert df.select(E.sequence_distance(F.col("a"), F.col("b"))).first()[0] == 2


def test_punctuation_counts(spark):
    out = one(spark, E.punctuation_operations()(F.col("r"), F.col("h")), r="Hi, you. Ok?", h="Hi you! Ok")
    marks = {m.mark: (m.correct, m.deletions, m.insertions, m.substitutions) for m in out}
    assert marks["."] == (0, 0, 0, 1) and marks[","] == (0, 1, 0, 0) and marks["?"] == (0, 1, 0, 0) and marks["!"] == (0, 0, 0, 0)


def test_tokens(spark):
    assert one(spark, K.utf8_bytes(F.col("t"), 3), t="aé") == [100, 198, 172]
    assert one(spark, K.from_utf8_bytes(K.utf8_bytes(F.col("t"), 3), 3), t="aé日") == "aé日"
    assert one(spark, K.utf8_bytes(F.col("t")), t="") == []
    assert one(spark, K.character_ids(F.col("t"), ["a", "b", " ", "<x>"]), t="Ab <x> c") == [0, 1, 2, 3, 2]
    assert one(spark, K.words_and_marks(F.col("t")), t="Don't |STOP| now!") == ["don't", "|stop|", "now", "!"]
    assert one(spark, K.arpabet_as_ipa(F.col("t")), t="HH AH0 L OW1") == "hʌloʊ"
    assert one(spark, K.syllables(F.col("t")), t="HH AH0 L OW1") == 2
    assert one(spark, K.ipa_symbols(F.col("t")), t="tʃiːz") == ["tʃ", "iː", "z"]
    assert one(spark, K.phrase_hits(F.col("t"), ["new york", "york"]), t="in new york, yorkshire york") == ["new york", "york"]
    lexicon = spark.createDataFrame([("read", "R IY D"), ("read", "R EH D"), ("cat", "K AE T")], "word string, phonemes string")
    df = spark.createDataFrame([(1, "Cat read dog")], "id long, text string")
    assert K.pronounced(df, "text", lexicon, "id").first().phonemes == "K AE T read dog"


def test_library_tokens(spark):
    import public_tokenizers as P

    out = spark.createDataFrame([("hello",), (None,)], "t string").select(K.library_ids("sentencepiece", P.path("piece_bpe_32k.model"))("t").alias("i")).collect()
    assert out[0].i and out[1].i is None
    agg = one(spark, K.aggregated(F.lit("fr"), {"en": (F.array(F.lit(1)), 10), "fr": (F.array(F.lit(2)), 10)}))
    assert agg == [12]
