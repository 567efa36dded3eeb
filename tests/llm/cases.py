"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random
import re

NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, rows string"
UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text: str) -> str:
    return text.translate(UPPER)


def rows(texts):
    """Rows with columns whose names operators may use inside."""
    return [(k, t, "en", "s", len(t or ""), 0.5, 7, "x") for k, t in texts]


def awkward():
    rng = random.Random(5)
    words = ["the", "of", "License", "mit", "MIT", "apache", "général", "日本語", "x", "naïve", "public", "GNU", "a1", "zz", "-", "%%%", "]"]
    long = " ".join(rng.choice(words) + str(rng.randrange(900)) for _ in range(6000))
    passage = " ".join(f"word{i}" for i in range(60))
    lines = "\n".join(" ".join(rng.choice(words) for _ in range(8)) for _ in range(30))
    near = [f"n{i}" for i in range(120)]
    texts = [None, "", " \t\n ", "one", "two words", "MIT License", "the mit  license, apache\nlicense; GNU General Public License!",
             "a general public licensee and the public license", long, long, long + " tail", "intro " + passage + " outro", passage + "\n" + passage,
             "before\n" + lines, lines + "\nafter", "x\n" * 50, "y " * 200, " ".join(near), " ".join(near[:60] + ["other"] + near[60:]),
             " ".join(near).upper(), "a\x00b c\x1cd\x85e f", "😀 </s>[INST] \\ [/INST]"]
    made = [(i, t) for i, t in enumerate(texts)]
    made += [(3, "one"), (None, "one"), (None, None), (40, passage), (41, lines), (41, "same key, other text")]
    for i in range(100, 130):
        made.append((i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 90)))))
    return made
