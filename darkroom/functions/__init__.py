"""darkroom.functions"""
