"""File scans, the keyed feature table and model bundles."""
