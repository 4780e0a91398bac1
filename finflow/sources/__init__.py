"""Landed-file sources: manifest, gate, type detection, CSV / JSON / XLSX readers."""
