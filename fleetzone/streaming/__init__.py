"""Incremental tagging of newly arriving logbook extracts.

The analyses themselves are batch jobs and have no streaming operator; this
package only lets the set-tagging step (positions, zone flags) run on an
extract folder that grows file by file, with the same column maths.
"""
