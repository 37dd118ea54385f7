"""Plain versions of what several tests compare with."""

import re
import time
from pathlib import Path


def grams(text, window=10):
    """Windows of words as the decontamination takes them."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    size = min(window, len(words))
    return words, [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []


def hit_words(words, windows):
    """Positions of words inside any occurrence of a window."""
    hit = set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
    return hit


def thue_morse(length):
    """Two different texts that every polynomial of their bytes modulo 2**64 maps to one value, if its base is odd."""
    signs = [bin(i).count("1") % 2 for i in range(length)]
    return ["".join("ab"[s ^ flip] for s in signs) for flip in (0, 1)]


def shuffle_files(spark, but=None, up_to=0):
    """Bytes of the shuffled data on disk, by file. With `but`, others than these, and as they go in the
    background, after some seconds if there are more bytes than `up_to`."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    for _ in range(1 if but is None else 30):
        found = {}
        for path in (p for folder in folders for p in Path(folder).rglob("shuffle_*.data") if p not in (but or ())):
            try:
                found[path] = path.stat().st_size
            except FileNotFoundError:
                pass
        if sum(found.values()) <= up_to:
            break
        time.sleep(0.1)
    return found
