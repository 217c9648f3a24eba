"""Where data comes from: topics, message files, lake tables and the activity log."""
