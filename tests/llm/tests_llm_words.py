"""Plain word rules for brute-force versions."""
import random
import re


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(n)).capitalize() + "."
