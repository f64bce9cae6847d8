import random

import pytest

from folioforge.llm.spam import blocks, find_spam, is_sentence, itemised, units

rng = random.Random(11)
NOUNS, VERBS = "cells mice proteins embryos samples sections reads lysates kinases neurons".split(), "grew bound moved divided failed changed responded survived".split()


def coined():
    return "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))


def prose(n):
    return " ".join(
        f"The {coined()} {rng.choice(NOUNS)} of {coined()} line {rng.randint(1, 999)} {rng.choice(VERBS)} when the {rng.choice(NOUNS)} with {coined()} in tissue {rng.choice('ABCDEFG')} were kept at {rng.randint(4, 42)} degrees for {rng.randint(1, 99)} hours." for _ in range(n)
    )


SPAM = {
    "keywords": "cheap antibody kit, buy antibody kit, antibody kit sale, " * 30,
    "links": "\n".join(f"https://shop{rng.randint(0, 999)}.example/item-{rng.randint(0, 9999)}.html" for _ in range(30)),
    "tags": " ".join(f"#buy{rng.choice(NOUNS)} #{rng.choice(NOUNS)}kit" for _ in range(60)),
    "slogans": " ".join(f"Buy {rng.choice(NOUNS)} kit {rng.choice(['now', 'here', 'online'])}!" for _ in range(80)),
    "table of goods": "\n".join(f"SKU {rng.randint(10000, 99999)} | {rng.choice(NOUNS)} kit | {rng.choice([5, 10])} g | in stock" for _ in range(30)),
    "stuffed page": "The cells were kept.\n" + "peptide kit | " * 120,
}
FINE = {
    "prose": prose(12),
    "prose with a menu": "Home | About | Contact\n\n" + prose(12),
    "prose with links": prose(12) + "\n\nSee https://a.example/1 and https://b.example/2 and https://c.example/3.",
    "prose with genes": prose(10) + "\n\nGenes: ABC1, DEF2, GHI3, JKL4, MNO5, PQR6, STU7, VWX8.",
    "prose with a table": prose(10) + "\n\n" + "\n".join(f"T{i}\t{i}.5\t0.0{i}" for i in range(1, 9)),
    "one line": "Scale bar, 10 μm.",
}


def test_shares(spark):
    names = [*SPAM, *FINE]
    rows = [(i, {**SPAM, **FINE}[n], "en") for i, n in enumerate(names)] + [(100 + i, prose(8), "en" if i % 2 else None) for i in range(120)] + [(900, None, "en"), (901, "", None), (902, SPAM["keywords"], "en")]
    df = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "doc_id bigint, text string, lang string, bucket string, ratio double")
    got = {r.doc_id: r.stuffed_share > 0.5 for r in find_spam(df).collect()}
    assert {n: got[i] for i, n in enumerate(names)} == {**dict.fromkeys(SPAM, True), **dict.fromkeys(FINE, False)}
    assert not any(got[100 + i] for i in range(120)) and 900 not in got and 901 not in got and got[902]
    assert find_spam(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", [*SPAM.values(), *FINE.values(), "x" * 5000, "\n" * 5000, "."])
def test_blocks_keep_all_that_is_not_blank(text):
    joined = "".join("".join(b.split()) for b, _ in blocks(text))
    assert joined == "".join(text.split())
    assert all(0 <= real <= len(b) for b, real in blocks(text))


def test_sentences_and_items():
    assert is_sentence("The cells of line 5 grew in the dark.") and not is_sentence("Buy antibody kit online!") and not is_sentence("The cells of line 5 grew")
    assert list(units("One is here. Two!\nThree")) == ["One is here.", " Two!", "Three"]
    assert itemised("a, b, c") == 3 and itemised("https://x.example/y") == 19
