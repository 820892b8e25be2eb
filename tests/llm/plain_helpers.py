"""Plain versions that several tests compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


class Groups:
    """Plain union of linked items."""

    def __init__(self, items):
        self.above = {item: item for item in items}

    def least(self, item):
        while self.above[item] != item:
            item = self.above[item]
        return item

    def link(self, a, b):
        a, b = sorted((self.least(a), self.least(b)))
        self.above[b] = a
