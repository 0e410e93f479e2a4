"""Queries over conversations: turns, prompts, transcripts and error rates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import errors as E
from ..operators import conversations as C
from ..operators import joins as J
from ..operators import scoring as S
from ..session import spread
from .registered import query, table


@query("""WITH c AS (SELECT conv_id, turn, lower(role) AS role, coalesce(text, '') AS text FROM conversations)
SELECT conv_id, count(*) AS n_turns, string_agg(CASE role WHEN 'user' THEN '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) WHEN 'assistant' THEN '<|im_start|>assistant' || chr(10) || text || '<|im_end|>' || chr(10) ELSE '<|im_start|>system' || chr(10) || text || '<|im_end|>' || chr(10) END, '' ORDER BY turn, role) AS prompt FROM c GROUP BY conv_id""")
def prompts(spark, sf_dir):
    out = C.prompted(C.gathered(table(spark, sf_dir, "conversations")), "chatml")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), "prompt")


@query("""WITH c AS (SELECT conv_id, turn, lower(role) AS role, coalesce(text, '') AS text FROM conversations), l AS (SELECT *, max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS last FROM c)
SELECT conv_id, coalesce(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role) FILTER (WHERE turn >= last), '') AS answer FROM l GROUP BY conv_id""")
def answers(spark, sf_dir):
    """What the loss of a prompt is taken on: from the last assistant turn on."""
    return C.prompted(C.gathered(table(spark, sf_dir, "conversations")), "chatml").select("conv_id", "answer")


@query("SELECT conv_id, count(*) + CASE WHEN count(*) FILTER (WHERE lower(role) = 'system') = 0 THEN 1 ELSE 0 END AS n_turns, count(*) FILTER (WHERE lower(role) = 'user') AS user_turns FROM conversations GROUP BY conv_id")
def with_system_prompt(spark, sf_dir):
    df = C.with_system(C.gathered(table(spark, sf_dir, "conversations")), "You are helpful.")
    return df.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.size(F.filter("turns", lambda t: t["role"] == "user")).cast("long").alias("user_turns"))


@query("SELECT coalesce(role, 'all') AS role, count(*) AS n, round(avg(length(text)), 6) AS mean_chars FROM conversations GROUP BY ROLLUP (role)")
def role_rates(spark, sf_dir):
    return table(spark, sf_dir, "conversations").rollup("role").agg(F.count("*").alias("n"), F.round(F.avg(F.length("text")), 6).alias("mean_chars")).withColumn("role", F.coalesce("role", F.lit("all")))


@query("SELECT p_partkey, 'Describe the ' || coalesce(p_name, '') || ' by ' || coalesce(p_brand, '') || '.' AS prompt FROM part")
def template_prompts(spark, sf_dir):
    return C.filled(table(spark, sf_dir, "part"), "Describe the {p_name} by {p_brand}.", "prompt").select("p_partkey", "prompt")


PAIRS = "(SELECT p_partkey, p_type, p_size, p_name AS text, lead(p_name, 1, '') OVER (ORDER BY p_partkey) AS pred_text FROM part)"
DISTANCE = "(CASE WHEN pred_text = '' THEN len(string_split(text, ' ')) ELSE CAST(string_split(text, ' ')[1] <> string_split(pred_text, ' ')[1] AS INTEGER) + CAST(string_split(text, ' ')[2] <> string_split(pred_text, ' ')[2] AS INTEGER) END)"


def predictions(spark, sf_dir):
    """Each part's name with the next part's as its prediction: two words each."""
    part = table(spark, sf_dir, "part")
    following = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("pred_text"))
    return part.join(following, "p_partkey", "left").select("p_partkey", "p_type", "p_size", F.col("p_name").alias("text"), F.coalesce("pred_text", F.lit("")).alias("pred_text"))


@query(f"SELECT p_partkey, CAST({DISTANCE} AS BIGINT) AS word_errors, CAST(len(string_split(text, ' ')) AS BIGINT) AS ref_words, levenshtein(text, pred_text) AS char_errors, round({DISTANCE} / len(string_split(text, ' ')), 6) AS wer FROM {PAIRS}")
def error_rates(spark, sf_dir):
    return S.per_row(predictions(spark, sf_dir)).select("p_partkey", "word_errors", "ref_words", "char_errors", F.round("wer", 6).alias("wer"))


@query(f"SELECT p_type, CAST(sum({DISTANCE}) AS BIGINT) AS word_errors, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS ref_words, round(sum({DISTANCE}) / sum(len(string_split(text, ' '))), 6) AS wer, round(sum(levenshtein(text, pred_text)) / sum(length(text)), 6) AS cer FROM {PAIRS} GROUP BY p_type")
def error_rates_by_group(spark, sf_dir):
    return S.corpus(predictions(spark, sf_dir), "p_type").select("p_type", "word_errors", "ref_words", F.round("wer", 6).alias("wer"), F.round("cer", 6).alias("cer"))


@query(f"SELECT CASE WHEN p_size >= 0 AND p_size < 10 THEN '0-10' WHEN p_size >= 10 AND p_size < 30 THEN '10-30' ELSE 'other' END AS slot, count(*) AS n_rows, round(sum({DISTANCE}) / sum(len(string_split(text, ' '))), 6) AS wer FROM {PAIRS} GROUP BY 1")
def error_rates_by_slot(spark, sf_dir):
    return S.by_slots(predictions(spark, sf_dir), "p_size", [(0, 10), (10, 30)]).select("slot", "n_rows", F.round("wer", 6).alias("wer"))


@query(f"WITH g AS (SELECT p_type, sum({DISTANCE}) / sum(len(string_split(text, ' '))) AS wer FROM {PAIRS} GROUP BY p_type) SELECT p_type, round(wer, 6) AS wer FROM g UNION ALL SELECT NULL, round(avg(wer), 6) FROM g")
def mean_of_dataset_rates(spark, sf_dir):
    return S.mean_of_datasets(predictions(spark, sf_dir), "p_type").select("p_type", F.round("wer", 6).alias("wer"))


@query(f"SELECT p_type, round(avg(CAST(text = pred_text AS INTEGER)), 9) AS accuracy FROM {PAIRS} GROUP BY ROLLUP (p_type)")
def exact_matches(spark, sf_dir):
    return S.exact_matches(predictions(spark, sf_dir), "text", "pred_text", "p_type").select("p_type", F.round("accuracy", 9).alias("accuracy"))


@query("SELECT round(avg(CASE WHEN trim(coalesce(text, '')) = '' THEN 1 ELSE 0 END), 9) AS blank_share FROM conversations")
def blank_share(spark, sf_dir):
    return S.blank_share(table(spark, sf_dir, "conversations"), "text").select(F.round("blank_share", 9).alias("blank_share"))


@query("SELECT c_custkey, count(o_orderkey) AS n, max(o_totalprice) AS most FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def left_joined(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"), F.max("o_totalprice").alias("most"))


@query("SELECT o_custkey AS id, arg_max(o_orderkey, o_orderkey) AS o_orderkey, max(c_acctbal) AS c_acctbal FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY o_custkey")
def merged_last(spark, sf_dir):
    """Inner join on one key where the last of several right rows counts."""
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    right = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey")
    return J.merged(left, right, "id", "o_orderkey").select("id", "o_orderkey", "c_acctbal")


@query("SELECT DISTINCT a.n_regionkey, a.n_name AS n_name_a, b.n_name AS n_name_b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name")
def pairs_of_members(spark, sf_dir):
    return J.pairs_of(table(spark, sf_dir, "nation"), ["n_regionkey"], "n_name")


@query()
def error_operations(spark, sf_dir):
    """Insertions, deletions and substitutions of each turn against the conversation's next turn."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumn("pred_text", F.lead("text").over(w)).filter("pred_text is not null")
    return S.detailed(rows).select("conv_id", "turn", "tokens", "insertions", "deletions", "substitutions", "error_rate")


@query()
def punctuation_errors(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumn("pred_text", F.lead("text").over(w)).filter("pred_text is not null")
    counted = rows.withColumn("marks", E.punctuation_operations()(F.col("text"), F.col("pred_text")))
    return S.punctuation_rates(counted, ["role"])


@query()
def session_error_rates(spark, sf_dir):
    """cpWER of each conversation: its roles' transcripts against the same without every turn's first word."""
    said = table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("t"))
    sides = spread(said, "conv_id").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("reference"), F.sort_array(F.collect_list(F.regexp_replace("t", r"^\S+\s*", "")), asc=False).alias("hypothesis"))
    return sides.select("conv_id", S.session_errors("reference", "hypothesis").alias("x")).select("conv_id", "x.*")


@query(f"""WITH p AS (SELECT p_type, len(string_split(text, ' ')) AS r, CASE WHEN pred_text = '' THEN 0 ELSE len(string_split(pred_text, ' ')) END AS h, len(list_intersect(string_split(text, ' '), string_split(pred_text, ' '))) AS m1, CASE WHEN text = pred_text THEN 1 ELSE 0 END AS m2 FROM {PAIRS}),
s AS (SELECT p_type, CAST(sum(r) AS BIGINT) AS ref_len, CAST(sum(h) AS BIGINT) AS hyp_len, CAST(sum(m1) AS BIGINT) AS match_1, CAST(sum(h) AS BIGINT) AS total_1, CAST(sum(m2) AS BIGINT) AS match_2, CAST(sum(greatest(h - 1, 0)) AS BIGINT) AS total_2 FROM p GROUP BY p_type),
b AS (SELECT *, CASE WHEN hyp_len = 0 THEN 0.0 WHEN hyp_len >= ref_len THEN 1.0 ELSE exp(1 - ref_len / hyp_len) END AS brevity FROM s)
SELECT p_type, ref_len, hyp_len, match_1, total_1, match_2, total_2, CAST(round(brevity, 6) AS DOUBLE) AS brevity, CAST(round(CASE WHEN least(match_1, match_2) > 0 THEN 100 * brevity * exp((ln(match_1 / total_1) + ln(match_2 / total_2)) / 2) ELSE 0.0 END, 6) AS DOUBLE) AS bleu FROM b""")
def bleu(spark, sf_dir):
    """Names of two words against the next part's, up to pairs of words."""
    return S.ngram_matches(predictions(spark, sf_dir), ["p_type"], "text", "pred_text", 2).withColumns({c: F.round(c, 6) for c in ("brevity", "bleu")})


@query("""WITH p AS (SELECT d.doc_id, CAST(quality AS VARCHAR) AS y, CASE WHEN n_chars > 300 THEN '1' ELSE '0' END AS q FROM documents d JOIN labels USING (doc_id)),
m AS (SELECT y AS label, count(*) FILTER (WHERE y = q) AS tp, count(*) AS support, 0 AS found FROM p GROUP BY y UNION ALL SELECT q, 0, 0, count(*) FROM p GROUP BY q),
e AS (SELECT label, sum(tp) AS tp, sum(support) AS support, sum(found) AS found FROM m GROUP BY label)
SELECT label, round(CASE WHEN found = 0 THEN 0 ELSE tp / found END, 6) AS precision, round(CASE WHEN support = 0 THEN 0 ELSE tp / support END, 6) AS recall, CAST(support AS BIGINT) AS support FROM e""")
def classification(spark, sf_dir):
    df = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").withColumn("guess", (F.col("n_chars") > 300).cast("int"))
    return S.classification_report(df, "quality", "guess").filter(F.col("label").isin("0", "1")).select("label", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), "support")


SCORED = "(SELECT quality AS y, least(n_chars / 4000.0, 1.0) AS score, lang FROM documents JOIN labels USING (doc_id))"


def scored(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(F.col("quality").alias("y"), F.least(F.col("n_chars") / 4000.0, F.lit(1.0)).alias("score"), "lang")


@query(f"""WITH t AS (SELECT lang, score, sum(y) AS pos, count(*) AS n FROM {SCORED} GROUP BY lang, score), b AS (SELECT *, sum(n - pos) OVER (PARTITION BY lang ORDER BY score) - (n - pos) AS before FROM t),
s AS (SELECT lang, sum(pos * (before + (n - pos) / 2.0)) AS wins, sum(pos) AS p, sum(n - pos) AS m FROM b GROUP BY lang) SELECT lang, round(CASE WHEN p > 0 AND m > 0 THEN wins / (p * m) ELSE 0.5 END, 6) AS auc_roc FROM s""")
def roc_auc(spark, sf_dir):
    return S.ranked_auc(scored(spark, sf_dir), "y", "score", "lang").select("lang", F.round("auc_roc", 6).alias("auc_roc"))


@query(f"""WITH t AS (SELECT score, sum(y) AS pos, count(*) AS n FROM {SCORED} GROUP BY score), u AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS seen FROM t)
SELECT round(sum(pos * tp / seen) / sum(pos), 6) AS auc_pr FROM u""")
def pr_auc(spark, sf_dir):
    return S.average_precision(scored(spark, sf_dir)).select(F.round("auc_pr", 6).alias("auc_pr"))


@query(f"""WITH b AS (SELECT least(floor(score * 10), 9) AS bin, count(*) AS n, avg(y) AS acc FROM {SCORED} GROUP BY 1) SELECT round(sum(n * abs(acc - (bin + 0.5) / 10)) / sum(n), 6) AS ece FROM b""")
def calibration(spark, sf_dir):
    return S.calibration_error(scored(spark, sf_dir), 10).select(F.round("ece", 6).alias("ece"))


@query(f"""WITH s AS (SELECT y, least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM {SCORED}), a AS (SELECT avg(-CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS ce, avg(y) AS q FROM s)
SELECT round((-(q * ln(q) + (1 - q) * ln(1 - q)) - ce) / -(q * ln(q) + (1 - q) * ln(1 - q)), 6) AS nce FROM a""")
def cross_entropy(spark, sf_dir):
    return S.normalized_cross_entropy(scored(spark, sf_dir)).select(F.round("nce", 6).alias("nce"))


@query(f"""WITH c AS (SELECT y, least(greatest(ceil(score * 50), 0), 51) AS cell FROM {SCORED}), v AS (SELECT t, abs(coalesce(count(*) FILTER (WHERE y = 0 AND cell < t) / nullif(count(*) FILTER (WHERE y = 0), 0), 0) - coalesce(count(*) FILTER (WHERE y = 1 AND cell < t) / nullif(count(*) FILTER (WHERE y = 1), 0), 0)) AS v
FROM c, (SELECT unnest(generate_series(0, 50)) AS t) GROUP BY t) SELECT round(avg(v), 6) AS auc_yc, round(stddev_pop(v), 6) AS std_yc, round(max(v), 6) AS max_yc FROM v""")
def youden_curve(spark, sf_dir):
    return S.youden_curve(scored(spark, sf_dir), 50).select(*(F.round(c, 6).alias(c) for c in ("auc_yc", "std_yc", "max_yc")))


KEYS = ("red", "small ring", "widget")


@query("SELECT keyword, CAST(sum(least(r, h)) AS BIGINT) AS tp, CAST(sum(r) AS BIGINT) AS gt, CAST(sum(h) AS BIGINT) AS found FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS keyword, CAST(contains(' ' || text || ' ', ' {k} ') AS INTEGER) AS r, CAST(contains(' ' || pred_text || ' ', ' {k} ') AS INTEGER) AS h FROM {PAIRS}" for k in KEYS) + ") GROUP BY keyword")
def keyword_scores(spark, sf_dir):
    return S.keyword_scores(predictions(spark, sf_dir), list(KEYS)).select("keyword", "tp", "gt", "found")


@query(f"SELECT p_partkey, round(len(list_intersect(string_split(text, ' '), string_split(pred_text, ' '))) * 1.0 / len(string_split(text, ' ')), 6) AS recall FROM {PAIRS}")
def rouge_recall(spark, sf_dir):
    return S.rouge_n(predictions(spark, sf_dir), "text", "pred_text", 1).select("p_partkey", F.round("recall", 6).alias("recall"))


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^ \\t\\n\\r]+') AS t FROM documents)
SELECT doc_id, CAST(i AS INTEGER) AS place, CAST(least(100, len(t) - i * 100) AS BIGINT) AS n, t[i * 100 + 1] AS first FROM w, unnest(generate_series(0, CAST(ceil(len(t) / 100.0) AS BIGINT) - 1)) AS g(i)""")
def word_windows(spark, sf_dir):
    """Documents in windows of a hundred words."""
    from ..operators import intervals as I

    windows = I.fixed_windows(E.words(F.col("text")), 100)
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(windows).alias("place", "w")).select("doc_id", "place", F.size("w").cast("long").alias("n"), F.col("w")[0].alias("first"))


@query("SELECT conv_id, 1 + CASE WHEN max(CASE WHEN lower(role) = 'system' THEN 1 ELSE 0 END) = 1 THEN 1 ELSE 0 END AS leading, count(*) + 1 AS n_turns FROM conversations GROUP BY conv_id")
def with_context_turn(spark, sf_dir):
    """A context turn stands behind the system's turns and before all others."""
    df = C.with_context(C.gathered(table(spark, sf_dir, "conversations")).withColumn("context", F.lit("The context.")), "context")
    at = F.array_position(F.transform("turns", lambda t: t["value"]), "The context.")
    return df.select("conv_id", at.cast("int").alias("leading"), F.size("turns").cast("long").alias("n_turns"))


@query(f"""WITH c AS (SELECT p_partkey, CASE WHEN pred_text = '' THEN 0 ELSE greatest((a[1] = b[1])::INT + (a[2] = b[2])::INT, (a[1] = b[2])::INT, (a[2] = b[1])::INT) END AS common, len(a) AS n, CASE WHEN pred_text = '' THEN 0 ELSE len(b) END AS m FROM (SELECT *, string_split(lower(text), ' ') AS a, string_split(lower(pred_text), ' ') AS b FROM {PAIRS}))
SELECT p_partkey, common::BIGINT AS common, round(CASE WHEN m = 0 THEN 0 ELSE common / m END, 6) AS precision, round(common / n, 6) AS recall, round(CASE WHEN common = 0 THEN 0 ELSE 2 * common / (m + n) END, 6) AS f1 FROM c""")
def rouge_l_scores(spark, sf_dir):
    """Longest common subsequences of two words each; long ones against brute force in the tests."""
    out = S.rouge_l(predictions(spark, sf_dir), "text", "pred_text")
    return out.select("p_partkey", "common", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))
