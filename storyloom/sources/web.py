"""One request over HTTP under a profile's headers: the transport that crawl operators take."""

from __future__ import annotations

from urllib.error import HTTPError
from urllib.parse import urlsplit
from urllib.request import Request, urlopen

from ..functions.html import unpacked

# --- fixed values: headers of the request profiles ---
PAGES = "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8"
PAGES_AND_IMAGES = "text/html,application/xhtml+xml,application/xml;q=0.9,image/avif,image/webp,*/*;q=0.8"
ENGLISH = "en-US,en;q=0.9"
PROFILES = {
    "bingbot": {"User-Agent": "Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)", "Accept": PAGES, "Accept-Language": ENGLISH},
    "googlebot": {"User-Agent": "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", "Accept": PAGES, "Accept-Language": ENGLISH},
    "desktop-chrome": {
        "User-Agent": "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0.0.0 Safari/537.36", "Accept": PAGES_AND_IMAGES, "Accept-Language": ENGLISH,
        "Sec-Fetch-Dest": "document", "Sec-Fetch-Mode": "navigate", "Sec-Fetch-Site": "none", "Upgrade-Insecure-Requests": "1",
    },
    "desktop-firefox": {"User-Agent": "Mozilla/5.0 (X11; Linux x86_64; rv:133.0) Gecko/20100101 Firefox/133.0", "Accept": PAGES_AND_IMAGES, "Accept-Language": ENGLISH, "Upgrade-Insecure-Requests": "1"},
    "desktop-safari": {"User-Agent": "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/18.0 Safari/605.1.15", "Accept": PAGES, "Accept-Language": ENGLISH},
    "mobile-safari": {"User-Agent": "Mozilla/5.0 (iPhone; CPU iPhone OS 18_0 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/18.0 Mobile/15E148 Safari/604.1", "Accept": PAGES, "Accept-Language": ENGLISH},
}
# --- end of fixed values ---


class Web:
    """(url, profile) -> (status, bytes, content type, final url). Answers with an error status are answers; what gives none
    raises. Bodies come unpacked."""

    def __init__(self, agent: str = "storyloom/1.0", timeout: float = 30.0):
        self.agent, self.timeout = agent, timeout

    def headers(self, profile: str) -> dict[str, str]:
        own = {"User-Agent": self.agent, "Accept": PAGES, "Accept-Language": "en-US,en;q=0.8"}
        return {**(own if profile == "default" else PROFILES.get(profile, PROFILES["bingbot"])), "Accept-Encoding": "gzip"}

    def __call__(self, url: str, profile: str = "default") -> tuple[int, bytes, str, str]:
        parts = urlsplit(url)
        if not parts.scheme or not parts.netloc:
            raise ValueError(f"invalid url: {url}")
        try:
            answer = urlopen(Request(url, headers=self.headers(profile)), timeout=self.timeout)
        except HTTPError as e:
            answer = e
        with answer:
            body = unpacked(answer.read(), answer.headers.get("Content-Encoding"), url)
            return answer.status, body, answer.headers.get("Content-Type") or "", answer.geturl()
