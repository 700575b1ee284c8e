r"""Chat formatting by grammar round trip.

Grammar of a conversation, one turn per line group:

    turn   := open " " content " " close "\n"
    open   := "[INST]" | "[ANS]" | "<<SYS>>" | "[ROLE name]"      ("!" after the name: content is escaped)
    close  := "[/INST]" | "</s>" | "<</SYS>>" | "[/ROLE]"

A turn is rendered plainly and parsed again by a deterministic parser. If the parser does not
give back the same role and content, or the content holds a control string, the content is
escaped (a backslash before each control string and each backslash) and the turn parsed once more; a
turn that still differs stops the job. Whole conversations are parsed again from the output, and the
reader takes roles, texts and the loss mask (spans of assistant content) from there alone.

Cases: null roles and texts are empty. Turns are ordered by (turn, role, text), nulls first, so equal
rows stay as they are, each a turn. Conversations with a null id form one conversation. An empty table gives an empty
result. Only the named columns of the input are used. A conversation is one string and so one row;
rendering and checking work on turns, before conversations are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The template. Java patterns; the same strings mean the same to other engines.
OPENERS = {"user": ("[INST", "]"), "assistant": ("[ANS", "]"), "system": ("<<SYS", ">>")}
CLOSERS = {"user": "[/INST]", "assistant": "</s>", "system": "<</SYS>>"}
CONTROL = r"\\|\[/?INST|\[ANS|\[/?ROLE|</?s>|<</?SYS"
TURN = r"(?s)(\[INST!?\]|\[ANS!?\]|<<SYS!?>>|\[ROLE!? [^\]\n]*\]) (.*?) (\[/INST\]|</s>|<</SYS>>|\[/ROLE\])\n"
CLASH_TEXT = "</s>[INST] ok [/INST]"


def _by_role(role: Column, known: dict[str, Column | str], other: Column) -> Column:
    out = other
    for name, value in known.items():
        out = F.when(role == name, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def _role_name(role: Column) -> Column:
    """Names of other roles without the strings that end an opener."""
    for raw, safe in (("%", "%25"), ("]", "%5D"), ("\n", "%0A")):
        role = F.replace(role, F.lit(raw), F.lit(safe))
    return role


def _named_role(name: Column) -> Column:
    for raw, safe in (("\n", "%0A"), ("]", "%5D"), ("%", "%25")):
        name = F.replace(name, F.lit(safe), F.lit(raw))
    return name


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"({CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({CONTROL})", "$1")


def _opener(role: Column, escaped: Column) -> Column:
    mark = F.when(escaped, F.lit("!")).otherwise(F.lit(""))
    known = {r: F.concat(F.lit(a), mark, F.lit(b)) for r, (a, b) in OPENERS.items()}
    return _by_role(role, known, F.concat(F.lit("[ROLE"), mark, F.lit(" "), _role_name(role), F.lit("]")))


def _closer(role: Column) -> Column:
    return _by_role(role, CLOSERS, F.lit("[/ROLE]"))


def _role_of(opener: Column) -> Column:
    named = _named_role(F.regexp_extract(opener, r"(?s)^\[ROLE!? (.*)\]$", 1))
    return (
        F.when(opener.startswith("[INST"), "user").when(opener.startswith("[ANS"), "assistant")
        .when(opener.startswith("<<SYS"), "system").otherwise(named)
    )


def _is_escaped(opener: Column) -> Column:
    return opener.rlike(r"^(\[INST!|\[ANS!|<<SYS!|\[ROLE! )")


def _piece(role: Column, text: Column, escaped: Column) -> Column:
    content = F.when(escaped, escape(text)).otherwise(text)
    return F.concat(_opener(role, escaped), F.lit(" "), content, F.lit(" "), _closer(role), F.lit("\n"))


def _reads_back(piece: Column, role: Column, text: Column) -> Column:
    """Does the parser find exactly this turn in the piece?"""
    opener, content = F.regexp_extract(piece, TURN, 1), F.regexp_extract(piece, TURN, 2)
    plain = F.when(_is_escaped(opener), unescape(content)).otherwise(content)
    whole = F.char_length(opener) + F.char_length(content) + F.char_length(_closer(role)) + 3 == F.char_length(piece)
    return whole & (_role_of(opener) == role) & (plain == text)


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start and length in code points, from 0), n_escaped."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    plain = _piece(role, text, F.lit(False))
    tried = turns.withColumn("escaped", text.rlike(CONTROL) | ~_reads_back(plain, role, text))
    pieces = tried.withColumn("piece", _piece(role, text, F.col("escaped"))).withColumn(
        "piece",
        F.when(_reads_back(F.col("piece"), role, text), F.col("piece"))
        .otherwise(F.raise_error(F.lit("a turn can't be read back from its rendered form")).cast("string")),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    lead = F.char_length(_opener(role, F.col("escaped"))) + 1
    size = F.char_length("piece") - lead - 2 - F.char_length(_closer(role))
    placed = (
        pieces.withColumn("size", F.char_length("piece"))
        .withColumn("n", F.count(F.lit(1)).over(order))
        .withColumn("start", F.sum("size").over(order) - F.col("size") + lead)
        .withColumn("span", F.when(role == "assistant", F.struct("start", size.cast("long").alias("length"), "escaped")))
    )
    gathered = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("n", "piece", "span"))).alias("turns"),
        F.sum(F.col("escaped").cast("long")).alias("n_escaped"),
    )
    return gathered.select(
        "conv_id", F.array_join(F.col("turns.piece"), "").alias("formatted"),
        F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"), "n_escaped",
    )


def read_back(output: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text) as the parser finds them, loss_text by the mask alone."""
    openers = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1))
    contents = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2))
    pairs = F.arrays_zip(openers.alias("opener"), contents.alias("content"))
    turns = F.transform(pairs, lambda p: F.struct(
        _role_of(p["opener"]).alias("role"),
        F.when(_is_escaped(p["opener"]), unescape(p["content"])).otherwise(p["content"]).alias("text"),
    ))

    def masked(span: Column) -> Column:
        part = F.substring("formatted", span["start"].cast("int") + 1, span["length"].cast("int"))
        return F.when(span["escaped"], unescape(part)).otherwise(part)

    return output.select(
        "conv_id", "formatted", turns.alias("turns"),
        F.array_join(F.transform("loss_spans", masked), "").alias("loss_text"),
    )


def write_and_read(conversations: DataFrame, path: str) -> DataFrame:
    """Write the formatted conversations to ``path`` and return what its reader finds there."""
    rendered = render(conversations)
    rendered.write.parquet(path)
    return read_back(conversations.sparkSession.read.schema(rendered.schema).parquet(path))


def clash_rows(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose turns consist of control strings."""
    row = lambda turn, role: spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"),
        F.lit(role).alias("role"), F.lit(CLASH_TEXT).alias("text"),
    )
    return row(0, "user").unionByName(row(1, "assistant"))


def digests(read: DataFrame) -> DataFrame:
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


# The same digests from the source rows: what the round trip has to give back.
DIGEST_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'), (-1::BIGINT, 1::BIGINT, 'assistant', '</s>[INST] ok [/INST]')
), pieces AS (
  SELECT *, regexp_matches(text, '\\|\[/?INST|\[ANS|\[/?ROLE|</?s>|<</?SYS') AS esc,
    regexp_replace(text, '(\\|\[/?INST|\[ANS|\[/?ROLE|</?s>|<</?SYS)', '\\\1', 'g') AS safe,
    CASE role WHEN 'user' THEN 6 + 7 WHEN 'assistant' THEN 5 + 4 WHEN 'system' THEN 7 + 8
      ELSE 7 + length(replace(replace(replace(role, '%', '%25'), ']', '%5D'), chr(10), '%0A')) + 7 END AS marks
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(marks + CASE WHEN esc THEN 1 + length(safe) ELSE length(text) END + 3)::BIGINT AS formatted_chars
FROM pieces GROUP BY conv_id
"""
