"""Random keys without a digit, and of digits alone, reach the battery and pass it."""

import random

from conftest import prose

from searchloom.llm.secrets import RANDOM, KINDS, find_secrets

SMALL = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "letters": SMALL.upper() + SMALL,
    "capitals": SMALL.upper(),
    "small": SMALL,
    "digits": "0123456789",
}


def keys(name, n, length):
    drawn = random.Random(f"{name} {length}")
    return ["".join(drawn.choices(ALPHABETS[name], k=length)) for _ in range(n)]


def test_random_keys_of_letters_or_digits_alone(spark):
    planted = {name: keys(name, 50, 40) for name in ALPHABETS}
    rows = [(i, prose(i, 60) + f" {key} " + prose(i + 1, 20)) for i, key in enumerate(sum(planted.values(), []))]
    common = ["internationalization", "straightforwardness", "self-contained-piece", "responsibilities/all"]
    rows += [(-1 - i, prose(i, 30) + " " + word) for i, word in enumerate(common)]
    found = find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    drawn = {s["value"] for r in found for s in r["spans"] if s["kind_no"] == KINDS.index(RANDOM)}
    for name, all_keys in planted.items():
        assert len(drawn & set(all_keys)) >= 0.9 * len(all_keys), name
    assert drawn <= set(sum(planted.values(), []))
