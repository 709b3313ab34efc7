"""Small hand-made documents in the playlist format."""

from __future__ import annotations

import json
from pathlib import Path


def track(pos, uri, name=None, album="al:1", album_name=None, artist="ar:1", artist_name=None, duration=1000):
    return {
        "pos": pos,
        "track_uri": uri,
        "track_name": name or f"name of {uri}",
        "duration_ms": duration,
        "album_uri": album,
        "album_name": album_name or f"name of {album}",
        "artist_uri": artist,
        "artist_name": artist_name or f"name of {artist}",
    }


def playlist(pid, tracks=None, **changes):
    """A playlist; ``tracks=None`` leaves the array out."""
    record = {
        "pid": pid,
        "name": f"list {pid}",
        "collaborative": "false",
        "modified_at": 1493424000 + pid,
        "num_tracks": len(tracks or []),
        "num_albums": 1,
        "num_artists": 1,
        "num_followers": 1,
        "num_edits": 1,
        "duration_ms": 3_000_000_000,
    }
    if tracks is not None:
        record["tracks"] = tracks
    return record | changes


def write_slice(folder: Path, start: int, playlists, end: int | None = None) -> Path:
    """One pretty-printed document in a file named after its range."""
    path = Path(folder) / f"slice.{start}-{start + 999 if end is None else end}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"playlists": playlists}, indent=2))
    return path


def three_slices(folder: Path) -> Path:
    """Slices 0, 2000 and 10000 with clean dependencies, an empty list and a missing one."""
    a = track(0, "tr:a", album="al:1", artist="ar:1")
    b = track(1, "tr:b", album="al:2", artist="ar:1", duration=2000)
    c = track(0, "tr:c", album="al:3", artist="ar:2", duration=3000)
    write_slice(folder, 0, [playlist(0, [a, b], description="first"), playlist(1, [])])
    write_slice(folder, 2000, [playlist(2000, [c, {**a, "pos": 1}], collaborative="true"), playlist(2001)])
    write_slice(folder, 10000, [playlist(10000, [{**b, "pos": 0}, {**c, "pos": 1}, {**c, "pos": 2}])])
    return folder


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
