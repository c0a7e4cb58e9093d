"""darkroom.sources"""
