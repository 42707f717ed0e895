"""Remote models and downloads, where their libraries are installed: callables for ``providers.Callback``."""

from __future__ import annotations

import base64
import importlib
import json
import subprocess
from collections.abc import Callable

from .providers import Settings

#: Tokens that an answer about one frame may have.
ANSWER_TOKENS = 300
# The models that are asked where no name is set, for gaps and for images.
GAP_MODELS = {"openai": "gpt-4o", "gemini": "gemini-2.5-flash"}
IMAGE_MODELS = {"openai": "gpt-4o", "gemini": "gemini-1.5-pro"}
#: What a list of gaps looks like.
GAPS_SCHEMA = {
    "type": "object",
    "properties": {"gaps": {"type": "array", "items": {"type": "object", "properties": {k: {"type": "string"} for k in ("exact_timestamp", "context_snippet")}, "required": ["exact_timestamp", "context_snippet"], "additionalProperties": False}}},
    "required": ["gaps"],
    "additionalProperties": False,
}


def _client(library: str, key: str | None):
    try:
        module = importlib.import_module(library)
    except ImportError as e:
        raise RuntimeError(f"{library} is not installed") from e
    return module.OpenAI(api_key=key) if library == "openai" else module.Client(api_key=key)


def gaps(settings: Settings) -> Callable[[str], str]:
    """A prompt with a transcript -> JSON of its gaps."""
    key, model = settings.keys, settings.model or GAP_MODELS.get(settings.provider)

    def openai(prompt: str) -> str:
        kind = {"type": "json_schema", "json_schema": {"name": "gaps", "schema": GAPS_SCHEMA, "strict": True}}
        answer = _client("openai", key.get("OPENAI_API_KEY")).chat.completions.create(model=model, messages=[{"role": "user", "content": prompt}], response_format=kind)
        return answer.choices[0].message.content

    def gemini(prompt: str) -> str:
        form = {"response_mime_type": "application/json", "response_json_schema": GAPS_SCHEMA}
        return _client("google.genai", key.get("GEMINI_API_KEY")).models.generate_content(model=model, contents=prompt, config=form).text

    return _choose(settings, openai, gemini)


def describe(settings: Settings) -> Callable[[str, bytes], str]:
    """A prompt and a JPEG -> what it shows, stripped."""
    key, model = settings.keys, settings.model or IMAGE_MODELS.get(settings.provider)

    def openai(prompt: str, image: bytes) -> str:
        url = f"data:image/jpeg;base64,{base64.b64encode(image).decode()}"
        content = [{"type": "text", "text": prompt}, {"type": "image_url", "image_url": {"url": url}}]
        answer = _client("openai", key.get("OPENAI_API_KEY")).chat.completions.create(model=model, max_tokens=ANSWER_TOKENS, messages=[{"role": "user", "content": content}])
        return answer.choices[0].message.content.strip()

    def gemini(prompt: str, image: bytes) -> str:
        part = importlib.import_module("google.genai.types").Part.from_bytes(data=image, mime_type="image/jpeg")
        return _client("google.genai", key.get("GEMINI_API_KEY")).models.generate_content(model=model, contents=[prompt, part]).text.strip()

    return _choose(settings, openai, gemini)


def _choose(settings: Settings, openai: Callable, gemini: Callable) -> Callable:
    try:
        return {"openai": openai, "gemini": gemini}[settings.provider]
    except KeyError:
        raise ValueError(f"provider {settings.provider!r}") from None


def remote_video_id(url: str) -> str | None:
    """The video's id by its metadata; None on any failure."""
    try:
        said = subprocess.run(["yt-dlp", "--dump-single-json", "--no-playlist", "--skip-download", url], capture_output=True, check=True, timeout=120)
        return json.loads(said.stdout).get("id")
    except (OSError, subprocess.SubprocessError, ValueError):
        return None


def download(url: str, folder: str) -> bool:
    """A video and its English and Russian captions into a folder; whether that worked."""
    options = ["-f", "bestvideo[ext=mp4]+bestaudio[ext=m4a]/best[ext=mp4]/best", "--write-subs", "--write-auto-subs", "--sub-langs", "en,ru", "--sub-format", "vtt", "--no-playlist"]
    try:
        subprocess.run(["yt-dlp", *options, "-o", f"{folder}/%(id)s.%(ext)s", url], check=True)
    except (OSError, subprocess.SubprocessError):
        return False
    return True
