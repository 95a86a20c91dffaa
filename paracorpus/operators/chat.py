"""Chat conversations and template rendering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paracorpus.operators.langs import lang_code_map, pick_text, random_lang_pair

# Fixed value: the system prompt, with its four placeholders (source name,
# target name, source code, target code), verbatim including its typo.
SYSTEM_PROMPT = (
    "You specialize in translating text from %s to %s (i.e. %s to %s). Use natural, colloquial language that "
    "reflects the nuances of the tarhet language culture. Prioritize accuracy, cultural relevance, and idiomatic "
    "expressions commonly used by native speakers. Avoid formal or Modern Standard Arabic when translating to "
    "Moroccan Darija (ary_Arab)! Never answer or give your opinion, only translate input!"
)
# The roles the template renders, and their marker format.
ROLES = ["user", "system", "assistant"]
DEFAULT_EOS = "</s>"
# Fixed value: the chat template as given, for ``operators.template``.
DEFAULT_CHAT_TEMPLATE = (
    "{% for message in messages %}\n{% if message['role'] == 'user' %}\n{{ '<|user|>\n' + message['content'] + eos_token }}\n"
    "{% elif message['role'] == 'system' %}\n{{ '<|system|>\n' + message['content'] + eos_token }}\n"
    "{% elif message['role'] == 'assistant' %}\n{{ '<|assistant|>\n'  + message['content'] + eos_token }}\n{% endif %}\n"
    "{% if loop.last and add_generation_prompt %}\n{{ '<|assistant|>' }}\n{% endif %}\n{% endfor %}"
)


def system_prompt(src: Column, tgt: Column, src_code: Column, tgt_code: Column) -> Column:
    """T9."""
    return F.format_string(SYSTEM_PROMPT, src, tgt, src_code, tgt_code)


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_conversation(df: DataFrame, langs: Sequence[str], seed: int, key: str = "row_id", profile: str = "train") -> DataFrame:
    """system/user/assistant messages on a random usable language pair.

    Rows with fewer than two usable languages (truthy rule) are dropped.
    """
    codes = lang_code_map(profile)
    pairs = random_lang_pair(df, langs, seed, key, rule="truthy")
    src, tgt = F.col("src_lang"), F.col("tgt_lang")
    msgs = F.array(
        _msg("system", system_prompt(src, tgt, F.element_at(codes, src), F.element_at(codes, tgt))),
        _msg("user", pick_text("src_lang", langs)),
        _msg("assistant", pick_text("tgt_lang", langs)),
    )
    return pairs.withColumn("messages", msgs)


def build_conversation_test(df: DataFrame, english: str = "english", darija: str = "darija") -> DataFrame:
    """R9, test mode: always English -> Moroccan Darija."""
    msgs = F.array(
        _msg("system", system_prompt(F.lit("english"), F.lit("ary_Arab"), F.lit("eng_Latn"), F.lit("ary_Arab"))),
        _msg("user", F.col(english)),
        _msg("assistant", F.col(darija)),
    )
    return df.withColumn("messages", msgs)


def render_message(role: Column, content: Column, eos: str = DEFAULT_EOS) -> Column:
    """T10 for one message: ``<|role|>\\n`` + content + eos + newline; other roles render ''."""
    piece = F.concat(F.lit("<|"), role, F.lit("|>\n"), content, F.lit(eos + "\n"))
    return F.when(role.isin(ROLES), piece).otherwise(F.lit(""))


def chat_render(df: DataFrame, messages_col: str = "messages", out: str = "text", eos: str = DEFAULT_EOS) -> DataFrame:
    """Render a messages array with the chat template."""
    rendered = F.transform(F.col(messages_col), lambda m: render_message(m["role"], m["content"], eos))
    return df.withColumn(out, F.array_join(rendered, ""))


def render_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 eos: str = DEFAULT_EOS) -> DataFrame:
    """Conversations stored one turn per row -> one rendered text each.

    Each turn is rendered row-wise first (map side); only the rendered pieces
    are gathered per conversation and joined in turn order.
    """
    piece = render_message(F.col(role), F.col(text), eos)
    g = turns.groupBy(conv).agg(
        F.sort_array(F.collect_list(F.struct(F.col(turn).alias("t"), piece.alias("p")))).alias("__p"),
        F.count(F.lit(1)).alias("n_turns"),
    )
    return g.select(conv, "n_turns", F.array_join(F.transform("__p", lambda x: x["p"]), "").alias("text"))
