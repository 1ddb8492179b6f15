"""Readers and writers of record folders, document trees and archives."""
