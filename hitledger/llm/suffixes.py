"""Suffix arrays by linear grouping."""

from __future__ import annotations


def suffix_array(values: list[int]) -> list[int]:
    """The places of ``values`` in the lexicographic order of the suffixes that begin there;
    a suffix that ends is smaller than one that goes on.

    First the suffixes are grouped by their Lyndon prefix, the longest prefix that is a
    Lyndon word. Groups start as suffixes of equal first value and are visited once, in
    descending order. For each suffix of the visited group, the previous smaller suffix (the
    nearest to the left in a group not yet visited) is found through the pointers of visited
    ones. It is extended by this group's prefix, as often as it is pointed at, and so leaves
    its group for a new one directly above, higher the more often. Then groups are final,
    and their inner order follows without renaming or recursion: go through the suffixes in
    ascending order, and let each put the one to its left, and that one's chain of previous
    smaller suffixes, to the front of what is free in their groups.
    """
    n = len(values)
    by_value: dict[int, list[int]] = {}
    for place, value in enumerate(values):
        by_value.setdefault(value, []).append(place)
    members = [by_value[value] for value in sorted(by_value)]
    group = [0] * n
    for number, places in enumerate(members):
        for place in places:
            group[place] = number
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    above[-1:] = [-1]
    smaller = [-1] * n
    visited = bytearray(n)
    final: list[list[int]] = []
    number = len(members) - 1
    while number >= 0:
        # Those that left the group are still in its list.
        places = [place for place in members[number] if group[place] == number]
        pointed: dict[int, int] = {}
        for place in places:
            visited[place] = 1
            left = place - 1
            while left >= 0 and visited[left]:
                left = smaller[left]
            smaller[place] = left
            if left >= 0:
                pointed[left] = pointed.get(left, 0) + 1
        if places:
            final.append(places)
        if pointed:
            moved: dict[tuple[int, int], list[int]] = {}
            for left, times in pointed.items():
                moved.setdefault((times, group[left]), []).append(left)
            for times, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
                new = len(members)
                lefts = moved[times, old]
                members.append(lefts)
                for left in lefts:
                    group[left] = new
                upper = above[old]
                below.append(old)
                above.append(upper)
                above[old] = new
                if upper >= 0:
                    below[upper] = new
        number = below[number]

    free = [0] * len(members)
    start = 0
    for places in reversed(final):
        free[group[places[0]]] = start
        start += len(places)
    order = [-1] * n
    placed = bytearray(n)
    for k in range(-1, n):
        place = (order[k] if k >= 0 else n) - 1
        while place >= 0 and not placed[place]:
            placed[place] = 1
            own = group[place]
            order[free[own]] = place
            free[own] += 1
            place = smaller[place]
    return order
