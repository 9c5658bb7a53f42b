"""Tables written between steps: those of the library at large (hearth.sources.scratch)."""

from hearth.sources.scratch import BROADCAST_KEYS, dropped, folder, having_keys, stored, tidy

__all__ = ["BROADCAST_KEYS", "dropped", "folder", "having_keys", "stored", "tidy"]
