"""Random strings of every alphabet are found; names made of words are not."""

import random
import string

import pytest

from mercatura.llm import secrets

ALPHABETS = {
    "lower": string.ascii_lowercase,
    "upper": string.ascii_uppercase,
    "mixed": string.ascii_letters,
    "base32": string.ascii_uppercase + "234567",
    "base36": string.ascii_lowercase + string.digits,
}


@pytest.fixture(scope="module")
def encoding():
    with open(secrets.vocabulary_path(), "rb") as file:
        return secrets._encoding(file.read())


def is_found(text, encoding):
    return bool(secrets.random_spans(text, encoding, [], secrets.MOST_PER_TOKEN))


@pytest.mark.parametrize("name", ALPHABETS)
@pytest.mark.parametrize("length", [20, 26, 32, 40])
def test_random_strings(name, length, encoding):
    rng = random.Random(f"{name}{length}")
    made = ["".join(rng.choices(ALPHABETS[name], k=length)) for _ in range(300)]
    assert sum(is_found(f"see {s} here", encoding) for s in made) >= 0.85 * len(made)


@pytest.mark.parametrize(
    "text",
    [
        "MAXIMUM_CONNECTION_POOL_SIZE",
        "DEFAULT-REQUEST-TIMEOUT-30",
        "getElementByIdAndClassName",
        "internationalisation_of_words",
        "content/articles/history/index",
        "order_20240131_20240229_0001",
        "20240131-20240229-20240331",
        "12345678901234567890123",
        "--------------------------",
    ],
)
def test_names_and_numbers_are_not_random(text, encoding):
    assert not is_found(f"see {text} here", encoding)
