"""Readers, writers and the file-drop loader."""
