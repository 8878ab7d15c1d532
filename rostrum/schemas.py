"""Record shapes. Every field is nullable; an absent field is NULL."""

from __future__ import annotations

SITTING_FIELDS = [
    "term", "date", "toc_url", "day", "session", "type", "day_of_session", "duration_raw", "duration",
    "sitting_id", "sitting_day", "header", "sitting_uid", "sitting_nr", "note", "video_url", "video_time",
]

SPEECH_SCALARS = [
    "id", "url", "speaker", "speaker_title", "speaker_party", "speaker_url", "text", "prev_speech_url",
    "next_speech_url", "type", "committee", "started_at", "duration", "video_url", "bill_details",
]

# Fields that arrive as one string or as a list of strings.
SPEECH_LISTS = ["topic", "bill_title", "bill_url"]

SITTING = ", ".join(f"{f} string" for f in SITTING_FIELDS)
SPEECH = (
    ", ".join(f"{f} string" for f in SPEECH_SCALARS)
    + ", " + ", ".join(f"{f} array<string>" for f in SPEECH_LISTS)
    + f", plenary_sitting_details struct<{SITTING.replace(' string', ':string')}>"
)

# What the search table keeps of a speech, of its sitting, and of the sitting under a new name.
INDEX_SPEECH = [
    "id", "bill_title", "bill_url", "committee", "duration", "prev_speech_url", "next_speech_url", "speaker",
    "speaker_title", "speaker_party", "speaker_url", "url", "text", "type", "topic", "header",
]
INDEX_SITTING = [
    "video_url", "video_time", "term", "toc_url", "session", "date", "day", "day_of_session", "note",
    "sitting_nr", "sitting_uid", "sitting_id",
]
INDEX_RENAMED = ["duration", "duration_raw", "day", "type"]

METADATA_COLUMNS = ["Date", "Unk1", "NameAndParty", "RawSpeakerId", "SpeechType", "SpeakerType", "URL", "Hash"]

ENTITIES = "Hash string, Entities array<struct<text:string,tag:string>>"
CONCEPTS = "Hash string, Concepts array<struct<URI:string,types:string,confidence:double,support:int>>"
