"""Rule tables of the CRM domain and the columns built from them.

Codes, patterns and labels are fixed values.  Names of the operating company
(hosts, mail domains, resource tag) are parameters in :class:`Site`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import any_like, first_match, lower_or_blank, strict_name  # noqa: F401

# --- fixed values: activity codes by category ------------------------------
LEAD_CAPTURE = "Lead Capture"
ASSIGNMENT = "Lead Assignment Activity"
JUNK = "JUNK_EXCLUDE"
ASSIGNMENT_CODE = 2200

CATEGORY_CODES: dict[str, tuple[int, ...]] = {
    LEAD_CAPTURE: (
        3, 23, 209, 221, 226, 234, 239, 240, 254, 263, 267, 268, 270, 271, 272, 281, 282, 284, 292, 299,
        305, 310, 332, 343, 354, 398, 399, 404, 405, 406, 410, 411, 412, 428, 432, 513, 514, 516, 520, 521,
        922, 923, 924, 925, 926, 927, 928, 929),
    "Demo Scheduled": (259, 290, 315, 316, 920),
    "SE Marked Demo Schedule": (393,),
    "Demo Cancelled": (319,),
    "Demo Rescheduled": (318,),
    "Demo Completed - Webinars": (342, 397, 921),
    "SE Marked Demo Completed": (395,),
    "Payment Activity": (98, 9629),
    "Call Activity": (506, 507, 777, 2500, 2502),
    "Page Visit": (2, 510),
    ASSIGNMENT: (ASSIGNMENT_CODE,),
    JUNK: (295, 298, 433, 434, 436),
}
OTHER_CATEGORY = "Other / Unknown"

# --- fixed values: labels ---------------------------------------------------
STAR_LABELS = ("FourStar", "ThreeStar", "TwoStar", "OneStar")
LEGACY_STAR_LABELS = ("4 Star", "3 Star", "2 Star", "1 Star")
STAR_THRESHOLDS = (60, 40, 20)
SEGMENTS = ("New Lead", "Old Lead - Capture", "Old - Others")
LEGACY_SEGMENTS = ("New Lead", "Old Lead – Capture", "Old – Others")

# --- fixed values: partner programmes named in a source text -----------------
PROGRAM_TEXT_RULES = (
    (("%iit jammu%", "%design%"), "IIT Jammu Design"),
    (("%iit jammu%", "%ev%"), "IIT Jammu EV"),
)


@dataclass(frozen=True)
class Site:
    """Names of the operating company that the rules look for."""

    host: str = "site.example"
    landing_host: str = "grow.site.example"
    resource_tag: str = "site_resource"
    resources_label: str = "Site-Resources"
    internal_domains: tuple[str, ...] = ("internal.example", "internal.test")


DEFAULT_SITE = Site()


def activity_category(code: Column, *, legacy: bool = False) -> Column:
    """Business category of an activity code.

    The legacy build knows a single call code and no junk class.
    """
    codes = dict(CATEGORY_CODES)
    if legacy:
        codes["Call Activity"] = (506,)
        codes.pop(JUNK)
    return first_match([(label, code.isin(*values)) for label, values in codes.items()], OTHER_CATEGORY)


def source_bucket(source: Column, medium: Column, campaign: Column, display_name: Column,
                  site: Site = DEFAULT_SITE, *, legacy: bool = False) -> Column:
    """Marketing channel of an activity from its capture source.

    A NULL source fails every pattern and reaches the two rules for NULL.
    """
    text = F.lower(source)
    meta = any_like(text, "%facebook%", "%fb%", "%insta%", "%meta%")
    rules: list[tuple[str, Column]] = [
        ("Direct Grow", any_like(text, f"%{site.landing_host}%", "%direct grow%")),
        ("Youtube", any_like(text, "%youtube%", "%yt%", "%google_video%", "%video_ad%")),
    ]
    if not legacy:
        rules.append(("Meta - Resources",
                      (text == "ig") & lower_or_blank(campaign).like("%website_conv%")))
        meta = meta | (text == "ig")
    rules += [
        ("Meta", meta),
        ("Linkedin", text.like("%linkedin%")),
        ("Google Ads", any_like(text, "%google ads%", "%google_search%", "%search_ad%")),
        ("Email", any_like(text, "%email%", "%webengage%", "%kasplo%")),
        ("Whatsapp", text.like("%whatsapp%")),
        ("Organic", any_like(text, "%google.com%", "%bing%", "%yahoo%", "%duckduckgo%", "%yandex%")),
    ]
    if not legacy:
        rules.append(("Organic Resources",
                      (text == site.resource_tag) & (lower_or_blank(medium) == "organic")))
    rules += [
        ("Direct", text.like(f"%{site.host}%")),
        ("Meta", source.isNull() & any_like(F.lower(display_name), "%facebook%", "%meta%", "%fb%")),
        ("Email", source.isNull()),
    ]
    if legacy:
        rules.append((site.resources_label, text.like("%resource%")))
    return first_match(rules, "Others")


def refined_bucket(bucket: Column, lead_campaign: Column) -> Column:
    """Email traffic of leads that came through a Meta campaign counts as Meta."""
    from_meta = any_like(lower_or_blank(lead_campaign), "%facebook%", "%fb%", "%meta%")
    return F.when((bucket == "Email") & from_meta, F.lit("Meta")).otherwise(bucket)


def system_flag(email: Column, site: Site = DEFAULT_SITE) -> Column:
    """1 for test and staff leads, by mail domain."""
    internal = any_like(F.lower(email), *[f"%@{d}%" for d in site.internal_domains])
    return F.when(internal, 1).otherwise(0)


def domain_group(domain: Column) -> Column:
    text = F.lower(domain)
    return first_match([
        ("Mechanical", text.isin("mechanical", "mech", "manufacturing")),
        ("Electric Vehicles", text.isin("ev", "hev")),
        ("Embedded Systems", text.like("%embedded%")),
        ("Software / IT", text.isin("information tech", "fsd")),
        ("CAE / Simulation", text == "fea"),
        ("Electrical", text.like("%electr%")),
        ("Design", text.like("%design%")),
        ("Civil", text.like("%civil%")),
    ], "Others / Unknown")


def customer_profile(answer: Column) -> Column:
    text = F.lower(answer)
    return first_match([
        ("JOB SEEKER", any_like(text, "%job%", "%unemploy%", "%fresher%")),
        ("STUDENT", text.like("%student%")),
        ("WORKING PROFESSIONAL", any_like(text, "%working%", "%professional%", "%experience%")),
    ], "OTHERS")


def profile_code(answer: Column) -> Column:
    """Short code, exact spelling only."""
    return first_match([
        ("CWP", answer == "Working Professional"),
        ("NWP", answer.isin("Job Seeker", "Unemployed")),
        ("STU", answer == "Student"),
    ])


def star_from_score(score: Column, labels: tuple[str, ...] = STAR_LABELS) -> Column:
    rules = [(label, score >= t) for label, t in zip(labels, STAR_THRESHOLDS)]
    return first_match([*rules, (labels[-1], score.isNotNull())])


def duration_bucket(seconds: Column) -> Column:
    return first_match([
        ("<30s", seconds < 30), ("30-60s", seconds <= 60),
        ("60-180s", seconds <= 180), (">180s", seconds > 180),
    ])


def connected_flag(status1: Column, status2: Column) -> Column:
    return F.when((status1 == "Connected") & (status2 == "Connected"), 1).otherwise(0)


def dnp_flag(call_status: Column) -> Column:
    """1 when the lead did not pick up."""
    return F.when(call_status.isin("dnp", "dnpWithinLimit"), 1).otherwise(0)


def valid_call_flag(status1: Column, previous_at: Column, gap_seconds: Column) -> Column:
    """0 for ghost calls and for re-dials within five seconds."""
    has_status = F.length(F.trim(status1)) > 0
    spaced = previous_at.isNull() | (gap_seconds > 5)
    return F.when(has_status & spaced, 1).otherwise(0)


def program_interested(is_capture: Column, program: Column, source: Column) -> Column:
    """Programme of a capture: its own name, else what the source text says."""
    text = F.lower(source)
    named = [(label, any_like(text, a) & any_like(text, b)) for (a, b), label in PROGRAM_TEXT_RULES]
    return F.when(is_capture, F.coalesce(program, first_match(named)))
