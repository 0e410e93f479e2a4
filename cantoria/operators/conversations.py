"""Conversations as ordered arrays of turns, prompts from role templates, and table templates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "array<struct<role:string,type:string,value:string,duration:double,offset:double>>"


def gathered(rows: DataFrame, key: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Long rows (key, turn, role, text) -> (key, turns), in order of turn."""
    each = F.struct(F.col(turn).alias("turn"), F.lower("role").alias("role"), F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("value"), F.lit(None).cast("double").alias("duration"), F.lit(None).cast("double").alias("offset"))
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(each)).alias("t")).select(key, F.transform("t", lambda x: F.struct(*(x[c].alias(c) for c in ("role", "type", "value", "duration", "offset")))).alias("turns"))


def spread(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns) -> long rows."""
    return df.select(key, F.posexplode("turns").alias("turn", "t")).select(key, "turn", "t.*")


def flagged(df: DataFrame) -> DataFrame:
    """Adds has_audio, has_text, n_turns and the summed duration."""
    return df.withColumn("has_audio", F.exists("turns", lambda t: t["type"] == "audio")).withColumn("has_text", F.exists("turns", lambda t: t["type"] == "text")).withColumn("n_turns", F.size("turns")).withColumn("duration", F.aggregate("turns", F.lit(0.0), lambda s, t: s + F.coalesce(t["duration"], F.lit(0.0))))


def _turn(role: str, value: Column, kind: str = "text") -> Column:
    return F.struct(F.lit(role).alias("role"), F.lit(kind).alias("type"), value.alias("value"), F.lit(None).cast("double").alias("duration"), F.lit(None).cast("double").alias("offset"))


def with_system(df: DataFrame, prompt: str) -> DataFrame:
    """A system turn in front where there is none."""
    has = F.exists("turns", lambda t: t["role"] == "system")
    return df.withColumn("turns", F.when(has, F.col("turns")).otherwise(F.concat(F.array(_turn("system", F.lit(prompt))), "turns")))


def with_context(df: DataFrame, context: str) -> DataFrame:
    """A user turn of the context column's text in front of the first turn that isn't the system's, where the column has any."""
    lead = F.filter("turns", lambda t: t["role"] == "system")
    rest = F.filter("turns", lambda t: t["role"] != "system")
    return df.withColumn("turns", F.when(F.col(context).isNull(), F.col("turns")).otherwise(F.concat(lead, F.array(_turn("user", F.col(context))), rest)))


def from_question_answer(df: DataFrame, question: str, answer: str) -> DataFrame:
    return df.withColumn("turns", F.array(_turn("user", F.col(question)), _turn("assistant", F.col(answer))))


def around_placeholder(df: DataFrame, placeholders: list[str]) -> DataFrame:
    """Each turn cut at the first placeholder in it into text, audio and text; blank texts go. human and user are `user`, all others `assistant`."""
    mark = "|".join(re.escape(p) for p in placeholders)
    cut = df.select("*", F.posexplode("turns").alias("turn", "t")).withColumn("role", F.when(F.lower("t.role").isin("human", "user"), "user").otherwise("assistant"))
    parts = F.split(F.col("t.value"), mark, 2)
    text = lambda v: F.struct(F.lit("text").alias("type"), F.trim(v).alias("value"))
    pieces = F.when(F.size(parts) < 2, F.array(text(parts[0]))).otherwise(F.array(text(parts[0]), F.struct(F.lit("audio").alias("type"), F.regexp_extract("t.value", f"({mark})", 1).alias("value")), text(parts[1])))
    return cut.select(*(c for c in df.columns if c != "turns"), "turn", "role", F.posexplode(F.filter(pieces, lambda p: (p["type"] == "audio") | (p["value"] != ""))).alias("piece", "p")).select("*", "p.*").drop("p")


def swapped_roles(df: DataFrame) -> DataFrame:
    """user and agent (or assistant) change places, whatever their case; others stay."""
    other = lambda r: F.when(F.lower(r) == "user", F.lit("agent")).when(F.lower(r).isin("agent", "assistant"), F.lit("user")).otherwise(r)
    return df.withColumn("turns", F.transform("turns", lambda t: t.withField("role", other(t["role"]))))


def audio_tokens(turns: Column, seconds: float, mode: str = "input") -> Column:
    """Sum of ceil(duration / seconds) - 1 over audio turns: of the context (all but the last turn), the answer (the last) or all."""
    last = F.size(turns) - 1
    used = F.filter(turns, lambda t, i: (i < last) if mode == "context" else (i == last) if mode == "answer" else F.lit(True))
    return F.aggregate(F.filter(used, lambda t: t["type"] == "audio"), F.lit(0).cast("long"), lambda s, t: s + F.ceil(t["duration"] / seconds) - 1)


def duplex(df: DataFrame, key: str, shift: float = 0.0, drop_agent_first: bool = False) -> DataFrame:
    """Segments (key, speaker, start, ...) of agent and user in order of start; the agent's may be shifted, rows that the agent starts may go."""
    moved = df.withColumn("start", F.col("start") + F.when(F.lower("speaker").isin("agent", "assistant"), shift).otherwise(0.0))
    rows = moved.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "speaker", *(c for c in df.columns if c not in (key, "start", "speaker"))))).alias("segments"))
    return rows.filter(~F.lower(F.col("segments")[0]["speaker"]).isin("agent", "assistant")) if drop_agent_first else rows


def with_tags(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in tags.items()})


def resolved(path: Column, base: str) -> Column:
    """Relative paths under a base folder; URLs and absolute paths as they are."""
    return F.when(path.rlike(r"^(?:/|[A-Za-z][\w+.-]*:)"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))


def channel(channels: Column, selector: int | Column) -> Column:
    """An element by index, counted from 0; null beyond the last."""
    return F.get(channels, F.lit(selector) if isinstance(selector, int) else selector)


# table templates


def fields(template: str) -> list[str]:
    if template.count("{") != template.count("}") or re.search(r"\{[^}]*\{", template):
        raise ValueError(f"unbalanced or nested braces: {template}")
    return re.findall(r"\{([^}]*)\}", template)


def filled(df: DataFrame, template: str, name: str) -> DataFrame:
    """A column from a template with {columns}; an unknown column raises, null counts as empty."""
    missing = [f for f in fields(template) if f not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    parts = re.split(r"\{([^}]*)\}", template)
    return df.withColumn(name, F.concat(*(F.lit(p) if i % 2 == 0 else F.coalesce(F.col(p).cast("string"), F.lit("")) for i, p in enumerate(parts))))


# prompts

#: The public chat templates by family; {message} is a turn's text.
TEMPLATES: dict[str, dict[str, str]] = {
    "plain": {"user": "{message}", "assistant": "{message}"},
    "question_answer": {"user": "Instruct: {message}\nOutput:", "assistant": " {message}"},
    "llama2": {"bos": "<s>", "system_and_user": "[INST] <<SYS>>\n{system}\n<</SYS>>\n\n{message} [/INST]", "user": "[INST] {message} [/INST]", "assistant": " {message} </s>"},
    "llama3": {"bos": "<|begin_of_text|>", "system": "<|start_header_id|>system<|end_header_id|>\n\n{message}<|eot_id|>", "user": "<|start_header_id|>user<|end_header_id|>\n\n{message}<|eot_id|>", "assistant": "<|start_header_id|>assistant<|end_header_id|>\n\n{message}<|eot_id|>"},
    "chatml": {"system": "<|im_start|>system\n{message}<|im_end|>\n", "user": "<|im_start|>user\n{message}<|im_end|>\n", "assistant": "<|im_start|>assistant\n{message}<|im_end|>\n"},
    "gemma": {"bos": "<bos>", "user": "<start_of_turn>user\n{message}<end_of_turn>\n", "assistant": "<start_of_turn>model\n{message}<end_of_turn>\n"},
    "mistral": {"bos": "<s>", "user": "[INST] {message} [/INST]", "assistant": "{message}</s>"},
    "translation": {"user": "{message}", "assistant": "{message}"},
}


def prompted(df: DataFrame, family: str, thinking: bool | None = None) -> DataFrame:
    """Adds prompt, context and answer texts: every turn in its template, cut at the last assistant turn.

    Roles without a template raise at run time. thinking False puts an empty
    thought in front of the answer, as families that think expect.
    """
    t = TEMPLATES[family]
    merge = "system_and_user" in t
    turns = F.col("turns")
    if merge:
        system = F.filter("turns", lambda x: x["role"] == "system")
        rest = F.filter("turns", lambda x: x["role"] != "system")
    else:
        rest = turns

    def one(x: Column, i: Column) -> Column:
        out = F
        if merge:
            head, tail = t["system_and_user"].split("{system}")
            before, after = tail.split("{message}")
            out = out.when((x["role"] == "user") & (i == 0) & (F.size(system) > 0), F.concat(F.lit(head), system[0]["value"], F.lit(before), x["value"], F.lit(after)))
        for role in ("system", "user", "assistant"):
            if role in t:
                a, z = t[role].split("{message}")
                thought = F.when(F.lit(thinking is False and role == "assistant"), F.lit("<think>\n\n</think>\n\n")).otherwise(F.lit(""))
                out = out.when(x["role"] == role, F.concat(F.lit(a), thought, x["value"], F.lit(z)))
        return out.otherwise(F.raise_error(F.concat(F.lit(f"{family} has no template for role "), x["role"])))

    shown = df.withColumn("_shown", F.transform(rest, one)).withColumn("_last", F.array_max(F.transform(rest, lambda x, i: F.when(x["role"] == "assistant", i))))
    bos = F.lit(t.get("bos", ""))
    cut = F.coalesce(F.col("_last"), F.size("_shown"))
    out = shown.withColumn("context", F.concat(bos, F.array_join(F.slice("_shown", F.lit(1), cut), ""))).withColumn("answer", F.array_join(F.slice("_shown", cut + 1, F.size("_shown")), ""))
    return out.withColumn("prompt", F.concat("context", "answer")).drop("_shown", "_last")


def masked_ids(context: Column, answer: Column) -> Column:
    """struct(input_ids, mask) of token arrays: the mask is true on the answer."""
    return F.struct(F.concat(context, answer).alias("input_ids"), F.concat(F.transform(context, lambda x: F.lit(False)), F.transform(answer, lambda x: F.lit(True))).alias("mask"))


#: What a manifest may call a task, and what counts as yes.
TASKS = {"asr": "transcribe", "transcribe": "transcribe", "s2t_translation": "translate", "ast": "translate", "translate": "translate"}
YES = ("yes", "true", "1", "pnc")


def special_tokens(df: DataFrame, languages: list[str], task: str = "taskname", punctuation: str = "pnc") -> DataFrame:
    """Language codes, punctuation flag and task as <|...|> tokens; an unknown task raises at run time, rows without a field keep null."""
    out = df.withColumns({c: F.when(F.col(c).isNotNull(), F.concat(F.lit("<|"), F.col(c), F.lit("|>"))) for c in languages})
    table = F.create_map(*(F.lit(x) for kv in TASKS.items() for x in kv))
    known = F.coalesce(table[F.lower(F.col(task))], F.raise_error(F.concat(F.lit("unknown task "), F.col(task))).cast("string"))
    out = out.withColumn(task, F.when(F.col(task).isNotNull(), F.concat(F.lit("<|"), known, F.lit("|>"))))
    return out.withColumn(punctuation, F.when(F.col(punctuation).isNotNull(), F.when(F.lower(F.col(punctuation).cast("string")).isin(*YES), "<|pnc|>").otherwise("<|nopnc|>")))


FORMATS: dict[tuple[str, str], object] = {}


def prompt_format(kind: str, family: str | None = None):
    """Registers a function (DataFrame) -> DataFrame for rows of a kind, for one family or all."""
    def register(f):
        FORMATS[(kind, family or "*")] = f
        return f

    return register


def format_for(kind: str, family: str):
    found = FORMATS.get((kind, family)) or FORMATS.get((kind, "*"))
    if not found:
        raise KeyError(f"no prompt format for {kind} and {family}")
    return found


@prompt_format("conversation")
def _conversation(df: DataFrame) -> DataFrame:
    return prompted(df, "plain")
