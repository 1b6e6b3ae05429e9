"""Where the knowledge base is: a configured value, read from a JSON file.

The file beside this module holds a neutral example. A user's own is named in LINKFORGE_KNOWLEDGE_BASE, read once, or
given to the functions that take one: mark (a word of its host, by which its URLs are known), item_url and property_url
(what stands before an id) and wiki_hosts (parts of the hosts of wikis).
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path


@dataclass(frozen=True)
class KnowledgeBase:
    mark: str
    item_url: str
    property_url: str
    wiki_hosts: tuple[str, ...]

    @staticmethod
    def read(path: str | os.PathLike) -> KnowledgeBase:
        made = json.loads(Path(path).read_text(encoding="utf-8"))
        return KnowledgeBase(**{**made, "wiki_hosts": tuple(made["wiki_hosts"])})


@lru_cache(maxsize=1)
def configured() -> KnowledgeBase:
    return KnowledgeBase.read(os.environ.get("LINKFORGE_KNOWLEDGE_BASE") or Path(__file__).with_name("knowledge_base.json"))
