"""Options of the jobs."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

log = logging.getLogger(__name__)

# Fixed values.
LANGUAGES = ("english", "spanish", "french", "german", "italian", "portuguese", "dutch")
LANGUAGE_CODES = {
    "en": "english",
    "es": "spanish",
    "fr": "french",
    "de": "german",
    "it": "italian",
    "pt": "portuguese",
    "nl": "dutch",
}
TRACKING_PARAMETERS = (
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "fbclid",
    "gclid",
    "msclkid",
    "zanpid",
    "dclid",
    "_ga",
)
DATETIME_FORMAT = "%Y-%m-%d %H:%M:%S"
KNOWN_SPLIT_METHODS = ("camel", "snake", "kebab", "number", "team_names")


@dataclass(frozen=True)
class UrlSpec:
    """How a URL is standardized.

    ``drop_parameters``: a tuple removes those query keys, ``True`` removes all
    keys (or all but ``required_parameters``), ``None`` leaves the query alone.
    """

    default_scheme: str = "https"
    lower_host: bool = True
    drop_fragment: bool = True
    drop_parameters: tuple[str, ...] | bool | None = TRACKING_PARAMETERS
    required_parameters: tuple[str, ...] | None = None
    drop_trailing_slash: bool = True
    drop_www: bool = True


@dataclass(frozen=True)
class CleanSpec:
    """Options of the cleaning jobs; an unknown language falls back to English."""

    language: str = "english"
    split_methods: tuple[str, ...] | None = None
    split_before_lower: bool = False
    keep_numbers_joined: bool = False
    placeholders: bool = True
    custom_stop_words: tuple[str, ...] = ()
    url: UrlSpec = field(default_factory=UrlSpec)
    datetime_format: str = DATETIME_FORMAT
    datetime_threshold: float = 0.8
    #: Own patterns of dates in running text, with the date as first group.
    datetime_patterns: tuple[str, ...] | None = None
    clean_code: bool = False
    clean_code_if_found: bool = False
    #: Map English plurals by their ending. Endings alone also hit words like "series",
    #: so this is off unless asked for; a lemma table is the safer way.
    plurals: bool = False

    def __post_init__(self) -> None:
        if self.language not in LANGUAGES:
            log.warning("language %r is not supported, using english", self.language)
            object.__setattr__(self, "language", "english")
        for method in self.split_methods or ():
            if method not in KNOWN_SPLIT_METHODS:
                raise ValueError(f"unknown split method: {method}")
