"""Readers and writers: files, messages, stored API responses, shared work folder."""
