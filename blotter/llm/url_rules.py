"""The rules of the URL filter."""

from __future__ import annotations

from blotter.llm.url_filters import glob_rule, host_rule

# Fixed values.
HOST_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
BLOCKED = ["spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track", "clickbait*"]
ALLOWED = ["example.net/es/*.html"]

RULES = [
    *(host_rule(name, verdict) for name, verdict in HOST_RULES.items()),
    *(glob_rule(name, "block") for name in BLOCKED),
    *(glob_rule(name, "allow") for name in ALLOWED),
]
