"""Line-first quality rules, DataFrame functions only.

Each line that holds a word is judged by itself: it must have the punctuation of prose, must not be a navigation bar, must not
be boilerplate, must not be mostly symbols and must not shout. Lines that fail are removed; a document is rejected when
the base rule fails (too few words, or too many words in repeated 3-word windows) or when the lines removed held more
than ``max_loss`` of its text. One pass over the rows, no shuffle: memory is bounded by one text.

Defined cases: null, empty and blank texts have no words, so they fail the base rule and are not kept; lines without a
word are kept as they are; repeated rows are judged alike; an empty table gives an empty result; input columns named like
an added column give way to it, other names don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import java_words, let, packed, without

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS = 0.3
HAS_WORD = r"[^\x20\x09-\x0D]"
#: Punctuation that prose has after some word.
SENTENCE = r"""[.!?:;,…。！？"'”’»)\]](\s|\z)"""
#: Wording of page furniture, in English, German, French and Spanish; a point stands for a letter with an accent.
BOILERPLATE = (
    r"(?i)lorem ipsum|enable javascript|javascript is disabled|cookie policy|accept (all )?cookies|privacy policy|terms of (use|service)|all rights reserved|skip to (main )?content|sign (in|up) to|log ?in to continue|subscribe to our|share (this )?on (facebook|twitter)|click here|read more\z"
    r"|alle rechte vorbehalten|datenschutzerkl|nutzungsbedingungen|\bimpressum\b|cookies akzeptieren|hier klicken|weiterlesen\z|mehr erfahren\z|newsletter abonnieren"
    r"|tous droits r.serv.s|politique de confidentialit|mentions l.gales|conditions d.utilisation|accepter les cookies|cliquez ici|lire la suite\z|abonnez-vous"
    r"|todos los derechos reservados|pol.tica de (privacidad|cookies)|aviso legal|condiciones de uso|aceptar (las )?cookies|haga clic aqu|leer m.s\z|suscr.base"
)
#: One of these, in lower case, is in every text that the wording above can match.
HINTS = ["lorem ipsum", "javascript", "cookie", "privacy policy", "terms of", "rights reserved", "skip to", "sign in", "sign up", "log in", "login", "subscribe to", "share ", "click here", "read more"]
HINTS += ["rechte vorbehalten", "datenschutz", "nutzungsbedingungen", "impressum", "klicken", "weiterlesen", "mehr erfahren", "abonn"]
HINTS += ["tous droits", "confidentialit", "mentions l", "conditions d", "cliquez", "lire la suite"]
HINTS += ["derechos reservados", "privacidad", "aviso legal", "condiciones de uso", "clic aqu", "leer m", "suscr"]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
ADDED = [*BASE, "n_lines", "n_bad_lines", "loss", "kept", "clean_text"]


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))


def _count(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def _word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def with_repeated_words(docs: DataFrame, words: str, name: str) -> DataFrame:
    """Adds how many of the words lie in a 3-word window that occurs twice or more.

    Hashes of the windows are sorted first: most texts repeat none and end there. Windows whose hash recurs are then
    sorted by their words, so equal hashes of different windows don't count.
    """
    size = F.greatest(F.size(words) - 2, F.lit(0))
    keys = F.transform(F.slice(words, F.lit(1), size), lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))

    def doubled(s: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i - 1)["k"] == x["k"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["k"] == x["k"], F.lit(False))
        return F.transform(F.filter(s, same), lambda x: x["p"])

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)

    window = lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("k"), i.alias("p"))
    few = F.filter(F.transform("_keys", lambda x, i: F.when(F.array_contains("_often", x), i)), lambda i: i.isNotNull())
    maybe = F.when(F.size("_often") <= 64, few).otherwise(F.sequence(F.lit(0), size - 1))
    exact = let(F.sort_array(F.transform(maybe, window)), lambda s: let(F.sort_array(doubled(s)), covered))
    sorted_ = docs.withColumn("_keys", keys).withColumn("_sorted", F.sort_array("_keys"))
    often = sorted_.withColumn("_often", F.array_distinct(F.filter("_sorted", lambda x, i: F.coalesce(F.get("_sorted", i + 1) == x, F.lit(False)))))
    return often.withColumn(name, F.when(F.size("_often") == 0, F.lit(0).cast("long")).otherwise(exact)).drop("_keys", "_sorted", "_often")


def line_ok(line: Column, hinted: Column) -> Column:
    """The verdict on one line; true for a line without a word. hinted: whether the text can hold boilerplate at all."""
    words = _count(line, " ") + 1
    navigation = _count(line, "|") * 5 > words
    shouting = ~line.rlike(r"\p{Ll}") & line.rlike(r"(\p{Lu}[^\p{Lu}]*){8}")
    return ~line.rlike(HAS_WORD) | (line.rlike(SENTENCE) & ~navigation & (_symbols(line) * 10 <= words) & ~shouting & ~(hinted & line.rlike(BOILERPLATE)))


def quality_rules(docs: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the base measures, the verdict ``kept`` and ``clean_text`` (the text without failed lines)."""
    docs = without(docs, ADDED)
    row, docs = docs.columns, packed(docs, ["text"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    worded = lambda lines: F.filter(lines, lambda x: x.rlike(HAS_WORD))
    split = docs.withColumns({"_words": java_words(F.col("text")), "_lines": F.split(text, "\n", -1), "n_symbols": _symbols(text).cast("long"), "_low": F.lower(text)})
    hinted = F.lit(False)
    for hint in HINTS:
        hinted = hinted | F.col("_low").contains(hint)
    split = split.withColumn("_hinted", hinted)
    judged = split.withColumns({"_good": let(F.col("_hinted"), lambda h: F.filter("_lines", lambda x: line_ok(x, h))), "_worded": worded(F.col("_lines"))})
    measured = with_repeated_words(judged, "_words", "n_repeat_words").withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": _word_chars(F.col("_words")),
            "n_dup_lines": (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long"),
            "n_lines": F.size("_worded").cast("long"),
            "n_bad_lines": (F.size("_lines") - F.size("_good")).cast("long"),
            "clean_text": F.array_join("_good", "\n"),
        }
    )
    left = F.when(F.col("n_bad_lines") == 0, F.col("word_chars")).otherwise(_word_chars(java_words(F.col("clean_text"))))
    lost = 1 - left / F.greatest(F.col("word_chars"), F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    verdict = ~F.col("base_failed") & (F.col("loss") <= max_loss)
    judged = measured.withColumns({"loss": lost, "base_failed": failed}).withColumn("kept", verdict)
    # one generated row a row: filters on the verdict stay above it, where each measure is computed once
    out = judged.select("row", F.explode(F.array(F.struct(*ADDED))).alias("found")).select("row", "found.*")
    return out.select(*[F.col("row").getField(c).alias(c) for c in row], *ADDED)
