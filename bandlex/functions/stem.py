"""Porter stemming (M. F. Porter, 1980) as a cascade of built-in Spark expressions.

The working form of a word has its vowels in upper case and its consonants in lower
case (``y`` is either), so that the tests of the algorithm are short patterns: a vowel
followed by a consonant somewhere is m > 0, and so on.  One projection per step keeps
shared sub-expressions from being inlined over and over, and one working column keeps
the generated method below the 8000 bytes of bytecode beyond which the JVM would only
interpret it; the whole cascade stays inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The suffix rules of the published algorithm, with the two later
# departures of its author (bli -> ble, logi -> log).  The first suffix that matches
# decides, whether or not its condition on m then holds.
LONG_SUFFIXES = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "bli": "ble",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
    "logi": "log",
}
SHORT_SUFFIXES = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
DROPPED_SUFFIXES = (
    "al",
    "ance",
    "ence",
    "er",
    "ic",
    "able",
    "ible",
    "ant",
    "ement",
    "ment",
    "ent",
    "sion",
    "tion",
    "ou",
    "ism",
    "ate",
    "iti",
    "ous",
    "ive",
    "ize",
)
VOWELS = "aeiou"

#: A word that ends with none of these is its own stem: every step cuts or replaces one of them.
ENDINGS = ("s", "ed", "ing", "y", "e", "ll", *LONG_SUFFIXES, *SHORT_SUFFIXES, *DROPPED_SUFFIXES)

# Patterns over the working form.
_CONSONANT = "[b-df-hj-np-tv-xz]"
_M_OVER_0 = "[A-Z][a-z]"
_M_OVER_1 = "[A-Z][a-z]+[A-Z]+[a-z]"
# m = 1 and consonant, vowel, consonant at the end, the last one not w, x or y
_SHORT = "^[a-z]+[A-Z][a-vz]"

_WORD, _RULE, _OPEN = "__word", "__rule", "__open"


def _vowels_up(word: Column) -> Column:
    # one replacement per vowel: translate looks every letter up as a string of its own
    for vowel in VOWELS:
        word = F.replace(word, F.lit(vowel), F.lit(vowel.upper()))
    return word


def _settled(marked: Column) -> Column:
    """A run of ``y`` alternates, so it is settled in pairs: each match starts behind the
    letter before the run or where the match before it ended (``\\G``)."""
    settled = F.regexp_replace(marked, rf"(?:(?<={_CONSONANT})|\G(?!^))y(y?)", "Y$1")
    return F.regexp_replace(settled, r"(?:(?<=[AEIOU])|^|\G)yy", "yY")


def working_form(word: Column) -> Column:
    """Vowels in upper case; a ``y`` is a vowel exactly when it follows a consonant."""
    marked = _vowels_up(word)
    return F.when(marked.contains("y"), _settled(marked)).otherwise(marked)


def _mark(letters: str) -> str:
    return "".join(ch.upper() if ch in VOWELS else ch for ch in letters)


def _drop(text: Column, n: Column | int) -> Column:
    return F.left(text, F.length(text) - n)


def _may_change(word: Column) -> Column:
    """Whether a step may change the word, by its ending alone."""
    endings = [s for s in dict.fromkeys(ENDINGS) if not any(s != t and s.endswith(t) for t in ENDINGS)]
    return reduce(or_, (word.endswith(s) for s in endings)) & (F.length(word) > 2)


def _first_rule(suffixes) -> Column:
    """1-based number of the first suffix the word ends with, 0 when there is none."""
    cases = (f"WHEN endswith({_WORD}, '{_mark(s)}') THEN {n}" for n, s in enumerate(suffixes, start=1))
    return F.expr(f"CASE WHEN NOT {_OPEN} THEN 0 {' '.join(cases)} ELSE 0 END")


def _pick(values, none, rule: Column) -> Column:
    return F.coalesce(F.get(F.lit([none, *values]), rule), F.lit(none))


def add_stem(df: DataFrame, token: str = "token", term: str = "term") -> DataFrame:
    """Append the stem of ``token``, a lower-case ``a``-``z`` word, as column ``term``."""
    kept = [name for name in df.columns if name != term]
    word, rule, is_open = F.col(_WORD), F.col(_RULE), F.col(_OPEN)
    # never null, which spares the generated code a null test per expression
    plan = df.select(*kept, F.coalesce(F.col(token), F.lit("")).alias(_WORD))
    # words whose ending no step looks at pass all of them by
    plan = plan.withColumn(_OPEN, _may_change(word))
    plan = plan.withColumn(_WORD, F.when(is_open, _vowels_up(word)).otherwise(word))
    plan = plan.withColumn(_WORD, F.when(is_open & word.contains("y"), _settled(word)).otherwise(word))

    # plurals: letters to cut
    plan = plan.withColumn(
        _RULE,
        F.when(~is_open, 0)
        .when(word.endswith("ssEs") | word.endswith("IEs"), 2)
        .when(word.endswith("s") & ~word.endswith("ss"), 1)
        .otherwise(0),
    )
    plan = plan.withColumn(_WORD, F.when(rule > 0, _drop(word, rule)).otherwise(word))

    # -eed, -ed, -ing: letters to cut
    plan = plan.withColumn(
        _RULE,
        F.when(~is_open, 0)
        .when(word.endswith("EEd"), F.when(word.rlike(_M_OVER_0 + ".*EEd$"), 1).otherwise(0))
        .when(word.endswith("Ed") & word.rlike("[A-Z].*Ed$"), 2)
        .when(word.endswith("Ing") & word.rlike("[A-Z].*Ing$"), 3)
        .otherwise(0),
    )
    plan = plan.withColumn(_WORD, F.when(rule > 0, _drop(word, rule)).otherwise(word))
    # after a removed -ed or -ing, 1 restores a final e, -1 undoes a double consonant;
    # of two y one is a vowel, so a double one shows as Yy
    plan = plan.withColumn(
        _RULE,
        F.when(rule < 2, 0)
        .when(word.endswith("At") | word.endswith("bl") | word.endswith("Iz"), 1)
        .when(word.rlike(r"(?:([^A-Zlsz])\1|Yy)$"), -1)
        .when(word.rlike(_SHORT + "$"), 1)
        .otherwise(0),
    )
    plan = plan.withColumn(
        _WORD, F.when(rule > 0, F.concat(word, F.lit("E"))).when(rule < 0, _drop(word, 1)).otherwise(word)
    )

    # final y
    plan = plan.withColumn(
        _WORD, F.when(is_open & (word.endswith("y") | word.endswith("Y")) & word.rlike("[A-Z].*[yY]$"), F.concat(_drop(word, 1), F.lit("I"))).otherwise(word)
    )

    # suffixes replaced where m > 0 before them
    for rules in (LONG_SUFFIXES, SHORT_SUFFIXES):
        plan = plan.withColumn(_RULE, _first_rule(rules))
        stem = _drop(word, _pick(map(len, rules), 0, rule))
        replaced = F.concat(stem, _pick(map(_mark, rules.values()), "", rule))
        plan = plan.withColumn(_WORD, F.when((rule > 0) & stem.rlike(_M_OVER_0), replaced).otherwise(word))

    # suffixes dropped where m > 1 before them; -ion only after s or t, which stays
    plan = plan.withColumn(_RULE, _first_rule(DROPPED_SUFFIXES))
    stem = _drop(word, _pick((3 if s in ("sion", "tion") else len(s) for s in DROPPED_SUFFIXES), 0, rule))
    plan = plan.withColumn(_WORD, F.when((rule > 0) & stem.rlike(_M_OVER_1), stem).otherwise(word))

    # final e, then final ll
    plan = plan.withColumn(
        _WORD,
        F.when(
            word.endswith("E") & word.rlike(_M_OVER_0 + ".*E$") & ~word.rlike(_SHORT + "E$"), _drop(word, 1)
        ).otherwise(word),
    )
    stem = F.lower(F.when(word.endswith("ll") & word.rlike(_M_OVER_1), _drop(word, 1)).otherwise(word))
    whole = F.coalesce(F.col(token), F.lit(""))
    # The generator is a barrier: a filter on the stem, also one inferred from a join,
    # would otherwise be moved below the steps, which inlines each into the next and
    # grows beyond any memory.
    return plan.select(*kept, F.explode(F.array(F.when(is_open, stem).otherwise(whole))).alias(term))
