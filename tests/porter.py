"""A letter-by-letter stemmer after the published definition, to check the Spark one."""

from bandlex.functions.stem import LONG_SUFFIXES, SHORT_SUFFIXES

# The suffixes that the published algorithm's fourth step removes.
GONE = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
    "iti", "ous", "ive", "ize",
)


def is_consonant(word, i):
    if word[i] in "aeiou":
        return False
    return word[i] != "y" or i == 0 or not is_consonant(word, i - 1)


def shape(word):
    kinds = []
    for i, ch in enumerate(word):
        kinds.append("v" if ch in "aeiou" or (ch == "y" and i > 0 and kinds[-1] == "c") else "c")
    return "".join(kinds)


def measure(word):
    kinds = shape(word)
    return sum(1 for a, b in zip(kinds, kinds[1:]) if a + b == "vc")


def short_end(word):
    return shape(word).endswith("cvc") and word[-1] not in "wxy"


def longest(word, endings):
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


def stem(word):
    if len(word) <= 2:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    ending = longest(word, ("eed", "ed", "ing"))
    if ending == "eed":
        if measure(word[:-3]) > 0:
            word = word[:-1]
    elif ending and "v" in shape(word[: -len(ending)]):
        word = word[: -len(ending)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif len(word) > 1 and word[-1] == word[-2] and shape(word)[-1] == "c":
            if word[-1] not in "lsz":
                word = word[:-1]
        elif measure(word) == 1 and short_end(word):
            word += "e"
    if word.endswith("y") and "v" in shape(word[:-1]):
        word = word[:-1] + "i"
    for rules in (LONG_SUFFIXES, SHORT_SUFFIXES):
        ending = longest(word, rules)
        if ending and measure(word[: -len(ending)]) > 0:
            word = word[: -len(ending)] + rules[ending]
    ending = longest(word, GONE)
    if ending:
        rest = word[: -len(ending)]
        if measure(rest) > 1 and (ending != "ion" or rest.endswith(("s", "t"))):
            word = rest
    whole = measure(word)
    if word.endswith("e") and (whole > 1 or (whole == 1 and not short_end(word[:-1]))):
        word = word[:-1]
    if word.endswith("ll") and whole > 1:
        word = word[:-1]
    return word
