"""Plain versions of what operators 2, 4 and 7 add to their contracts."""

import math
import unicodedata
from collections import Counter

from plain import WORD


def token_measures(pieces, text):
    """Tokens, byte tokens and entropy in bits of a text's words, each encoded by itself."""
    ids = [i for w in WORD.findall(text or "") for i in pieces.encode(w)]
    shares = [n / len(ids) for n in Counter(ids).values()]
    return len(ids), sum(pieces.is_byte(i) for i in ids), -sum(p * math.log2(p) for p in shares)


def script(text):
    names = {"LATIN": "latin", "CYRILLIC": "cyrillic", "GREEK": "greek", "CJK": "han", "HIRAGANA": "kana", "KATAKANA": "kana"}
    found = Counter(names.get(unicodedata.name(c, "").split(" ")[0], "other") for c in text or "" if c.isalpha())
    return min(found, key=lambda s: (-found[s], s)) if found else "none"


def fertile(bands, kind, chars, tokens, by_bytes, entropy):
    """The verdict of the bands: characters a token, share of bytes, entropy against its ceiling (512 tokens)."""
    if kind == "none" or tokens == 0:
        return False
    low, high, most_bytes, least, most = bands[kind] if kind in bands else bands["other"]
    relative = entropy / math.log2(max(2, min(tokens, 512)))
    return low <= chars / tokens <= high and by_bytes / tokens <= most_bytes and relative >= least and (tokens > 512 or relative <= most)


def statistics(text):
    """The classifier's statistics by name, character by character."""
    text = text or ""
    words = WORD.findall(text)
    n = max(1, len(words))
    byte_count = max(1, sum(len(w.encode()) for w in words))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n_lines = max(1, len(lines))
    share = lambda good, of: sum(map(good, text)) / of
    ends = [WORD.findall(x)[-1][-1] for x in lines]
    punctuation = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    return {
        "log_words": math.log(1 + len(words)),
        "word_length": sum(len(w.encode()) for w in words) / n,
        "symbol_share": share(lambda c: c in "#*$%&<>", n),
        "pipe_share": share(lambda c: c == "|", n),
        "mark_share": share(lambda c: c in "!?", n),
        "upper_share": share(lambda c: "A" <= c <= "Z", byte_count),
        "digit_share": share(lambda c: "0" <= c <= "9", byte_count),
        "punctuation_share": share(lambda c: c in punctuation, byte_count),
        "wide_share": share(lambda c: c >= "\u00c0", byte_count),
        "distinct_share": len(set(words)) / n,
        "top_word_share": max(Counter(words).values(), default=0) / n,
        "repeat_share": sum(often[w] > 1 for w in windows) / n,
        "dup_line_share": (len(lines) - len(set(lines))) / n_lines,
        "words_per_line": len(words) / n_lines,
        "stopped_line_share": sum(e in ".!?" for e in ends) / n_lines,
    }


def rule_score(names, intercept, rules, values):
    """The logistic score of weighted conjunctions (feature, side, bound) over statistics by name."""
    logit = intercept
    for weight, rule in rules:
        if all(values[names[f]] <= bound if side == "<=" else values[names[f]] > bound for f, side, bound in rule):
            logit += weight
    return 1 / (1 + math.exp(-logit))


#: Names and values as they are planted, and whether a literal of that name and value is a secret.
PLANTED_NAMES = {"db_password": True, "AUTH_SECRET": True, "awsAccessKey": True, "colour": False, "publicKeyPath": False, "tokenCount": False, "title": False}
PLANTED_VALUES = {"gH7kQ2vXz9LmP4sT": True, "xV3.nB8/qW1+eR6=": True, "changeme": False, "xxxxxxxx": False, "abc": False}
FORMS = ['{name} = "{value}"', "{name}: '{value}'", "\"{name}\": \"{value}\",", "cfg['{name}'] = '{value}'", "{name} := `{value}`", '{name}: str = "{value}"', "{name} = b'{value}'", '{name} = """{value}"""', "{name} = {value}"]


def planted_source(rng):
    """(text, spans of the literals that are secrets): source lines written with the place of each known."""
    text, spans, constants = "", set(), []
    for i in range(rng.randint(0, 8)):
        text += rng.choice(["", "\n", "# notes on the set-up\n", "for x in rows\n", "if a == b\n", "    "])
        name = f"n{i}_{rng.choice(list(PLANTED_NAMES))}"
        good_name = PLANTED_NAMES[name.split("_", 1)[1]]
        kind = rng.random()
        if kind < 0.2 and constants:  # a name stands for a constant written further up
            source, span, good = rng.choice(constants)
            text += f"{name} = {source}\n"
            if good and good_name:
                spans.add(span)
            constants.append((name, span, good))
            continue
        value = rng.choice(list(PLANTED_VALUES))
        line = rng.choice(FORMS).replace("{name}", name)
        if line.endswith(" = {value}") and len(value) < 6:
            line = name + ' = "{value}"'
        begin = len(text) + line.index("{value}")
        span = (begin, begin + len(value))
        text += line.replace("{value}", value) + "\n"
        if good_name and PLANTED_VALUES[value]:
            spans.add(span)
        if "cfg[" not in line:
            constants.append((name, span, PLANTED_VALUES[value]))
    return text, spans
