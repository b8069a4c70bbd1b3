"""Jobs (daily append/merge/check/publish, replays, demand jobs), the stand-in
fixtures and the driver query catalog."""
