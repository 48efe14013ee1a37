"""Text functions as column expressions; grammars that need a scanner as pandas functions."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def written_form(text: Column) -> Column:
    """Drops [pronunciation] that is attached to a word."""
    return F.regexp_replace(text, r"([\p{L}\p{N}])\[[^\[\]\n]*\]", "$1")


def spoken_form(text: Column) -> Column:
    """Replaces word[pronunciation] by the pronunciation, as it is written."""
    return F.regexp_replace(text, r"[\p{L}\p{N}:'-]*[\p{L}\p{N}]\[([^\[\]\n]*[^\[\]\n\s][^\[\]\n]*)\]", "$1")


def final_word(text: Column) -> Column:
    return F.coalesce(F.try_element_at(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), 1), F.lit(-1)), F.lit(""))


def is_stop_coda(word: Column) -> Column:
    return word.rlike("(p|t|c|ch)$")


def ends_sentence(text: Column) -> Column:
    return F.rtrim(text).rlike("[.!?…]$")


def slug(text: Column, limit: int = 60) -> Column:
    """ASCII letters and digits in lower case with single _ between, cut at a separator within the limit; letters lose
    their marks (compatibility decomposition)."""

    @F.pandas_udf("string")
    def bare(texts: pd.Series) -> pd.Series:
        return texts.str.lower().str.replace("đ", "d").str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")

    joined = F.regexp_replace(F.regexp_replace(bare(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    cut = F.regexp_replace(F.substring(joined, 1, limit), "_[^_]*$", "")
    return F.when(F.length(joined) <= limit, joined).otherwise(cut)


def family_name(collection: Column, title: Column) -> Column:
    return F.concat_ws("__", slug(collection), slug(title))


def audio_family(given: Column, path: Column) -> Column:
    """The family that is given; else the folder above a speaker's folder; else the file name without its times and
    number."""
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    folder = F.regexp_extract(path, r"([^/]+)/spk_\d+/[^/]+$", 1)
    name = F.regexp_extract(path, r"([^/]+?)(?:_\d{8,10}-\d{8,10})?(?:_\d{4})?\.\w+$", 1)
    return F.coalesce(blank(given), blank(folder), blank(name))


_CONSONANT = "[bcdfghjklmnpqrstvwxz]{1,2}>"


def square_fillers(text: Column) -> Column:
    """<uh> as [uh]; a consonant that a hyphen joins to a syllable, as in <s>-trét, stays."""
    joined = rf"<(?!{_CONSONANT}-[\p{{L}}<])(?:(?<![\p{{L}}>]-<)|(?!{_CONSONANT}))([a-z]+(?:[_-][a-z]+)*)>"
    return F.regexp_replace(text, joined, "[$1]")


def unwrap_brackets(text: Column, preserved: Sequence[str] = ()) -> Column:
    """Pronunciations in brackets without them: /phonemes/ between slashes, or letters and marks joined by _ or -. Names in
    `preserved` and all else keep their brackets."""
    keep = r"(?!\s*(?i:" + "|".join(map(re.escape, preserved)) + r")\s*\])" if preserved else ""
    phonemes, letters = r"/(?=[^/]*\S)[^/\[\]<>_\r\n\t-]+/", rf"(?=[^\]]*\p{{L}})(?:<{_CONSONANT}|[\p{{IsLatin}}\p{{M}}_-])+"
    return F.regexp_replace(text, rf"\[{keep}({phonemes}|{letters})\]", "$1")


def transcript(answer: Column) -> Column:
    """The transcript of a model's answer: of its JSON, else of a line `transcript: ...`; null if it says there is none."""
    json_ = F.get_json_object(answer, "$.transcript")
    line = F.regexp_extract(answer, r"(?im)^\s*transcript\s*:[ \t]*(.+?)\s*$", 1)
    found = F.trim(F.coalesce(json_, F.nullif(line, F.lit(""))))
    return F.when(~F.lower(found).isin("", "null", "none", "n/a"), found)


def clip_name(stem: Column, speaker: Column, start_ms: Column, end_ms: Column, index: Column) -> Column:
    return F.format_string("%s_%s_%09d-%09d_%04d.wav", stem, speaker, start_ms, end_ms, index)


def clip_bounds_ms(name: Column) -> tuple[Column, Column]:
    part = lambda i: F.nullif(F.regexp_extract(name, r"_(\d{8,10})-(\d{8,10})_", i), F.lit("")).cast("long")
    return part(1), part(2)


def strip_backend(stem: Column) -> Column:
    return F.regexp_replace(stem, "_(gemini|hf|endpoint|vllm|moss)$", "")


def timestamp_label(seconds: Column) -> Column:
    """h:mm:ss.mmm"""
    ms = F.round(seconds * 1000).cast("long")
    return F.format_string("%d:%02d:%02d.%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def percent_label(share: Column) -> Column:
    """Share as percent with two decimals, n/a if there is none."""
    return F.when(share.isNotNull(), F.format_string("%.2f%%", share * 100)).otherwise("n/a")


def markdown_cell(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("|"), F.lit("\\|")), r"[\r\n]+", " ")


def redacted(line: Column) -> Column:
    """A line of a log without the credentials of its addresses and keys."""
    return F.regexp_replace(F.regexp_replace(line, r"(\w+://)[^/@\s]+@", "$1***@"), r"(?i)((?:api_?key|token|password|secret)=)[^&\s]+", "$1***")


def listing_kind(url: Column) -> Column:
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    return F.when(F.try_parse_url(url, F.lit("QUERY"), F.lit("list")).isNotNull(), "playlist").when(path.rlike("^/(@|channel/|c/|user/)"), "channel").otherwise("video")


def listing_url(url: Column) -> Column:
    """The address of the list that a video's address names, else the address itself."""
    named = F.try_parse_url(url, F.lit("QUERY"), F.lit("list"))
    return F.when(named.isNotNull(), F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("HOST")), F.lit("/playlist?list="), named)).otherwise(url)


def safe_endpoint(url: Column) -> Column:
    """An address without credentials, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^(\w+://)[^/@]*@", "$1")


def rate_limit(text: Column) -> Column:
    """Bytes of 500K, 2M, 1.5G or a plain number; null if it isn't one."""
    number = F.nullif(F.regexp_extract(F.trim(text), r"^(\d+(?:\.\d+)?)([KMG]?)$", 1), F.lit("")).cast("double")
    unit = F.regexp_extract(F.trim(text), r"^(\d+(?:\.\d+)?)([KMG]?)$", 2)
    return (number * F.when(unit == "K", 1024).when(unit == "M", 1024**2).when(unit == "G", 1024**3).otherwise(1)).cast("long")


def formula_guard(cell: Column) -> Column:
    return F.when(cell.rlike("^[=+@-]"), F.concat(F.lit("'"), cell)).otherwise(cell)


def compare_status(reference: Column, candidate: Column) -> Column:
    """missing, exact, case_only or different."""
    return F.when(candidate.isNull(), "missing").when(reference == candidate, "exact").when(F.lower(reference) == F.lower(candidate), "case_only").otherwise("different")


def _salvage(text: str | None, sort: bool = True) -> str | None:
    body = re.sub(r"<think>.*?</think>", "", text or "", flags=re.S)
    fences = re.findall(r"```(?:json)?\s*(.*?)```", body, flags=re.S)
    for part in [*fences[::-1][:1], body]:
        decoder, at = json.JSONDecoder(), len(part)
        try:
            return json.dumps(json.loads(part), ensure_ascii=False, sort_keys=sort)
        except ValueError:
            pass
        best = None
        for at in (m.start() for m in re.finditer(r"[{\[]", part)):
            try:
                value, end = decoder.raw_decode(part, at)
            except ValueError:
                continue
            if best is None or end > best[1]:
                best = (value, end)
        if best:
            return json.dumps(best[0], ensure_ascii=False, sort_keys=sort)
    return None


def json_payload(text: Column) -> Column:
    """The JSON that a model's answer holds, whatever stands around it: without think blocks, of the last code fence,
    else the value that ends last. Keys sorted; null if there is none."""
    return F.pandas_udf(lambda s: pd.Series([_salvage(x) for x in s]), "string")(text)


FIELDS = "decision string, speaker_purity string, word_completeness string, audio_quality string, failure_codes array<string>, transcript string, emotion string, boundary_start string, boundary_end string"

#: Fixed values of a verdict's fields; the first of each says that nothing is wrong.
SPEAKERS = ("pure", "secondary_speaker", "overlapping_speech")
BOUNDARIES = ("complete", "clipped_word_start", "clipped_word_end")
QUALITIES = ("studio_clean", "music_bleed", "noisy_reverberant", "distorted")
#: Fixed codes that no field gives.
INELIGIBLE = ("unsupported_language", "singing")


def _parsed(answer: Column) -> Column:
    return F.from_json(json_payload(answer), FIELDS)


def answer_error(answer: Column) -> Column:
    """invalid_json, json_not_object, or null for an answer that holds an object."""
    body = json_payload(answer)
    return F.when(body.isNull(), "invalid_json").when(~body.startswith("{"), "json_not_object")


#: Fixed profiles of prompts, what a prompt of the acoustic one begins with, and what one that wants an emotion holds.
ACOUSTIC, PURITY, BOUNDARY, VIBE = "acoustic_defect_v3", "speaker_purity_v1", "word_boundary_v1", "vibevoice_v1"
HEADINGS = ("Listen to the supplied audio directly. Perform both acoustic verification and transcription", "# SYSTEM PROMPT — ACOUSTIC QC")
WANTS_EMOTION = "EMOTION / SPEAKING STYLE"


def _json_keys(text: str | None) -> list[str] | None:
    found = _salvage(text, sort=False)
    value = json.loads(found) if found else None
    return list(value) if isinstance(value, dict) else None


def checked_verdict(answer: Column, prompt: Column, backend: Column, known: Mapping[str, str]) -> Column:
    """(profile, error) of a verdict: the profile of the prompt that it answers (known prompts have theirs), and the first thing
    that is wrong by that profile, in its order; null if nothing is. Without an object or a decision the profile is unknown."""
    v, body = _parsed(answer), json_payload(answer)
    keys = F.pandas_udf(lambda s: pd.Series([_json_keys(x) for x in s]), "array<string>")(answer)
    is_object, decided = F.coalesce(body.startswith("{"), F.lit(False)), F.coalesce(v["decision"].isin("pass", "reject"), F.lit(False))
    text = F.trim(prompt)
    own = F.coalesce(*[F.when(text == p, name) for p, name in known.items()], F.lit(None).cast("string"))
    profile = F.when(~is_object | ~decided, "unknown").when(own.isNotNull(), own).when(text.startswith(HEADINGS[0]) | text.startswith(HEADINGS[1]), ACOUSTIC)
    profile = profile.when(prompt.isNull() & (backend == "vibevoice"), VIBE).otherwise("custom")
    is_pass = v["decision"] == "pass"
    among = lambda name, values: F.coalesce(v[name].isin(*values), F.lit(False))
    blank = lambda name: F.coalesce(F.trim(v[name]), F.lit("")) == ""

    fields = (("speaker_purity", SPEAKERS), ("word_completeness", BOUNDARIES), ("audio_quality", QUALITIES))
    codes = F.coalesce(v["failure_codes"], F.array().cast("array<string>"))
    codes_known = v["failure_codes"].isNotNull() & ~F.exists(codes, lambda x: ~F.coalesce(x.isin(*INELIGIBLE, *SPEAKERS[1:], *BOUNDARIES[1:], *QUALITIES[1:]), F.lit(False)))
    faults = F.filter(F.array(*[v[n] for n, _ in fields]), lambda x: ~x.isin(SPEAKERS[0], BOUNDARIES[0], QUALITIES[0]))
    due = F.array_sort(F.concat(faults, F.array_intersect(codes, F.array(*map(F.lit, INELIGIBLE)))))
    public = F.filter(keys, lambda k: ~k.startswith("_"))
    acoustic = F.lit(None).cast("string")
    for wrong, name in reversed([
        *[(~among(n, values), f"invalid_{n}") for n, values in fields],
        (v["emotion"].isNotNull() & blank("emotion"), "invalid_emotion"), (~codes_known, "invalid_failure_codes"), (F.array_sort(codes) != due, "inconsistent_failure_codes"),
        (is_pass != (F.size(due) == 0), "inconsistent_decision"), (is_pass & blank("transcript"), "missing_transcript"),
        (is_pass & F.coalesce(prompt.contains(WANTS_EMOTION), F.lit(False)) & blank("emotion"), "missing_emotion"),
        (is_pass & (F.element_at(public, -1) != "transcript"), "transcript_not_last"), (~is_pass & F.array_contains(keys, "transcript"), "unexpected_transcript"),
    ]):
        acoustic = F.when(wrong, name).otherwise(acoustic)
    purity = F.when(~among(*fields[0]), "invalid_speaker_purity").when(is_pass != (v["speaker_purity"] == SPEAKERS[0]), "inconsistent_decision")
    edges = [v["boundary_start"], v["boundary_end"]]
    ok_edges = among("boundary_start", ("clean", "clipped")) & among("boundary_end", ("clean", "clipped"))
    boundary = F.when(~ok_edges, "invalid_word_boundary").when(is_pass != ((edges[0] == "clean") & (edges[1] == "clean")), "inconsistent_decision")
    error = F.when(~is_object, "verdict_not_object").when(~decided, "invalid_decision").when(profile == ACOUSTIC, acoustic).when(profile == PURITY, purity).when(profile == BOUNDARY, boundary)
    return F.struct(profile.alias("profile"), error.alias("error"))


def verdict_codes(answer: Column) -> Column:
    """Sorted codes of a verdict: of its list, its fields and its clipped bounds, as far as they are known."""
    v = _parsed(answer)
    known = F.array(*map(F.lit, (*SPEAKERS[1:], *BOUNDARIES[1:], *QUALITIES[1:], *INELIGIBLE)))
    clipped = lambda c, code: F.when(v[c] == "clipped", code)
    own = F.array(v["speaker_purity"], v["word_completeness"], v["audio_quality"], clipped("boundary_start", "clipped_word_start"), clipped("boundary_end", "clipped_word_end"))
    return F.array_sort(F.array_intersect(known, F.array_compact(F.concat(F.coalesce(v["failure_codes"], F.array().cast("array<string>")), own))))


def flatten_answers(rows: DataFrame, answer: str) -> DataFrame:
    """rows with a verdict's fields as columns, its codes joined, and the number of words of its transcript."""
    flat = rows.withColumn("_v", _parsed(F.col(answer))).select(*rows.columns, "_v.*")
    words = F.when(F.col("transcript").isNotNull(), F.regexp_count("transcript", F.lit(r"\S+")))
    return flat.withColumn("words", words).withColumn("failure_codes", F.array_join("failure_codes", ";"))


def fingerprint(entries: Column) -> Column:
    """Digest of a map's JSON with sorted keys."""
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries)))), 256)


#: Fixed names of the emotions that annotated texts may have; neutral leaves no tag.
EMOTIONS = frozenset(
    "neutral calm excited happy amused playful proud warm tender grateful relieved hopeful angry frustrated annoyed impatient anxious fearful panicked disgusted sad "
    "disappointed hurt worried apologetic embarrassed tired bored nostalgic surprised shocked amazed curious confused hesitant skeptical confident determined serious "
    "pleading sarcastic contemptuous".split()
)
_LETTER = r"[^\W\d_]"
#: A word goes on over . , : / between digits and over an apostrophe between letters.
_WORD = rf"""(?:[^\s\[\]<>!?~*;"“”‘’'(){{}}«».,:/]|(?<=\d)[.,:/](?=\d)|(?<={_LETTER})['’](?={_LETTER}))+"""
_TOKEN = re.compile(rf"(?P<word>{_WORD})(?P<said>\[[^\]]*\])?|(?P<tag>\[[^\]]*\])|(?P<sound><[a-z]+(?:[_-][a-z]+)*>)|(?P<stray>[\[\]<>])|(?P<other>.)", re.S)
_CLOSING = tuple(".,!?~*;:")


def _pronunciation_error(said: str) -> str | None:
    if not said.strip() or any(c in "[]<>" for c in said):
        return "empty or nested annotation"
    if "/" in said:
        inner = said[1:-1]
        fine = len(said) > 2 and said[0] == said[-1] == "/" and inner.strip() and not any(c in "/_-\r\n\t" for c in inner)
    else:
        fine = all(c in "_-" or (c.isalpha() and "LATIN" in unicodedata.name(c, "")) or unicodedata.category(c)[0] == "M" for c in said)
    if not fine:
        return "unsupported pronunciation"
    return None if any(map(str.isalpha, said)) else "pronunciation without letters"


def _forms(text: str | None) -> tuple[str | None, str | None, str | None]:
    """(spoken, written, error) of one annotated text."""
    text = text or ""
    spoken, written, at = "", "", 0
    fail = lambda place, what: (None, None, f"character {place + 1}: {what}")
    while at < len(text):
        m = _TOKEN.match(text, at)
        start, at, kind = m.start(), m.end(), m.lastgroup
        if m["stray"]:
            return fail(start, "invalid sound tag" if m["stray"] == "<" else "unclosed bracket" if m["stray"] == "[" else "unmatched closing bracket")
        if m["word"]:
            written += m["word"]
            said = m["said"]
            if said is None and text[at : at + 1] == "[":
                return fail(at, "unclosed bracket")
            if said and start >= 2 and text[start - 1] in ".:/" and text[start - 2].isalnum():
                return fail(start, "ambiguous compound word")
            if said and (error := _pronunciation_error(said[1:-1])):
                return fail(m.start("said"), error)
            spoken += said[1:-1] if said else m["word"]
        elif m["tag"]:
            label, after = m["tag"][1:-1], text[at:]
            if not label.strip() or any(c in "[<>" for c in label):
                return fail(start, "empty or nested annotation")
            if label not in EMOTIONS or (start and not text[start - 1].isspace()):
                return fail(start, "unsupported standalone bracket")
            if after and not after[0].isspace() and not after.startswith(_CLOSING):
                return fail(at, "emotion isn't separated from speech")
            if label != "neutral":
                spoken, written = spoken + m["tag"], written + m["tag"]
                continue
            rest = after.lstrip()
            closing = not rest or rest.startswith(_CLOSING)
            if closing:
                spoken, written = spoken.rstrip(), written.rstrip()
            if closing or not spoken or spoken[-1].isspace():
                at = len(text) - len(rest)
        else:
            spoken, written = spoken + m[kind], written + m[kind]
    spoken, written = spoken.strip(), written.strip()
    return (spoken, written, None) if spoken and written else (None, None, "empty transcript")


def transcript_forms(text: Column) -> Column:
    """struct(spoken, written, error) of annotated text: word[pronunciation], [emotion], <sound>. The spoken form has the
    pronunciations, the written one the words; sounds and emotions but neutral stay in both."""
    return F.pandas_udf(lambda s: pd.DataFrame([_forms(x) for x in s], columns=["spoken", "written", "error"]), "spoken string, written string, error string")(text)
