"""tallywell.sources"""
