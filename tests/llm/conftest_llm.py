"""Helpers of the text-operator tests."""

import zlib

WORDS = ("the of and that with for der die und nicht ein schön für les des une été garçon los que niño también "
         "data model corpus token shard merge").split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "er", "ing", "s", "é"])) for _ in range(n))


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n
