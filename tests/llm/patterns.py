"""Texts that hashes by powers of one factor, modulo 2**64, cannot tell apart."""

import random


def paired(n=2048, seed=1):
    """Two lists that differ at every second place, by the sign of the Thue-Morse sequence."""
    pick = random.Random(seed)
    filler = [pick.choice("cdefghijklmnopqrstuvwxyz") for _ in range(n)]
    signs = [i.bit_count() % 2 for i in range(n)]
    return [[x for f, s in zip(filler, signs) for x in (f, "ab"[s ^ flip])] for flip in (0, 1)]


def one_words(n=2048):
    return ["".join("ab"[(i.bit_count() + flip) % 2] for i in range(n)) for flip in (0, 1)]
