"""Word lists and thresholds that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# Hazard classes in matching order, first hit wins.
HAZARD_TERMS = {
    "FLOOD": ["flood", "flooding", "flash flood", "waterlog", "inundation", "deluge"],
    "LANDSLIDE": ["landslide", "mudslide", "debris flow", "rockfall", "slope failure"],
    "EARTHQUAKE": ["earthquake", "tremor", "seismic", "quake", "aftershock"],
    "CYCLONE": ["cyclone", "hurricane", "typhoon", "storm surge", "tropical storm"],
    "DROUGHT": ["drought", "dry spell", "water scarcity", "water shortage"],
    "HEATWAVE": ["heatwave", "heat wave", "extreme heat"],
    "COLD_WAVE": ["cold wave", "snowstorm", "blizzard", "frost", "snowfall"],
    "FIRE": ["wildfire", "forest fire", "blaze"],
    "CLOUDBURST": ["cloudburst", "cloud burst", "heavy rain", "heavy rainfall"],
}

# Severity terms.
CRITICAL_TERMS = ["critical", "severe", "devastating", "catastrophic", "red alert", "emergency", "sos"]
WARNING_TERMS = ["warning", "alert", "caution", "watch", "advisory", "orange alert", "yellow alert"]

# Phrases that mark a text as relevant, in listed order.
DISASTER_KEYWORDS = [
    "landslide India", "flood India", "earthquake India", "cloudburst India", "cyclone India",
    "flash flood India", "avalanche India", "tsunami India", "Uttarakhand flood",
    "Uttarakhand landslide", "Uttarakhand cloudburst", "Himachal Pradesh landslide",
    "Himachal Pradesh flood", "Sikkim flood", "Sikkim landslide", "Kerala flood",
    "Kerala landslide", "Assam flood", "Brahmaputra flood", "Northeast India flood",
    "Manipur landslide", "NDRF rescue", "SDRF rescue", "NDMA India", "IMD warning",
    "disaster relief India", "rescue operations India", "highway blocked Uttarakhand",
    "Kedarnath disaster", "Chamoli disaster", "Joshimath sinking",
]

# Hosts whose media may be kept.
MEDIA_DOMAINS = [
    "ndtv.com", "thehindu.com", "hindustantimes.com", "timesofindia.indiatimes.com",
    "indiatimes.com", "indiatoday.in", "aninews.in", "news18.com", "theprint.in", "thewire.in",
    "scroll.in", "deccanherald.com", "tribuneindia.com", "firstpost.com", "outlookindia.com",
    "dnaindia.com", "zeenews.india.com", "newindianexpress.com", "telegraphindia.com",
    "livemint.com", "static.ndtv.com", "images.ndtv.com", "st1.latestly.com", "img.etimg.com",
    "akm-img-a-in.tosshub.com", "images.hindustantimes.com", "th.thgim.com",
    "images.deccanherald.com", "img.theweekendleader.com", "cdn.downtoearth.org",
    "reliefweb.int", "gdacs.org",
]

# Substrings that mark a URL as page furniture.
SKIP_URL_TERMS = [
    "logo", "icon", "avatar", "banner", "pixel", "tracker", "badge", "button", "sprite", "widget",
    "gravatar", "favicon", "ads", "advert", "analytics", "1x1", "blank.", "spacer",
]

# File extensions by media type.
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".webp", ".gif", ".tiff"]
VIDEO_EXTENSIONS = [".mp4", ".avi", ".mov", ".mkv", ".webm"]

# Thresholds and limits.
RAIN_WARNING_MM = 15.0
RAIN_CRITICAL_MM = 35.0
HAZARD_SCAN_CHARS = 500
ARTICLE_BODY_CHARS = 3000
MAX_FILE_BYTES = 10 * 1024 * 1024
MIN_IMAGE_WIDTH = 300
MIN_IMAGE_HEIGHT = 200
LOW_SAMPLE_MIN = 20
LOOKBACK_DAYS = 7
MAX_TWEETS = 500
MAX_POSTS_PER_SUBREDDIT = 100
REDDIT_POLL_SECONDS = 300
WEATHER_POLL_SECONDS = 1800

# Source names.
SOURCE_TYPES = ["twitter", "reddit", "news_api", "rss", "weather", "media"]


@dataclass(frozen=True)
class Taxonomy:
    """Term lists for hazard and severity labels.

    ``scan_chars`` limits the search to the leading characters of a text, for
    instance ``HAZARD_SCAN_CHARS``; ``None`` searches the whole text.
    ``word_boundary`` asks for whole words instead of substrings.
    """

    hazards: tuple[tuple[str, tuple[str, ...]], ...] = tuple(
        (name, tuple(terms)) for name, terms in HAZARD_TERMS.items()
    )
    critical: tuple[str, ...] = tuple(CRITICAL_TERMS)
    warning: tuple[str, ...] = tuple(WARNING_TERMS)
    scan_chars: int | None = None
    word_boundary: bool = False


DEFAULT = Taxonomy()
